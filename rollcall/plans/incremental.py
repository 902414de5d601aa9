"""Snapshots, overlays, audits and queues."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import keys
from rollcall.operators.dedupe import descending, keep_best
from rollcall.operators.upsert import insert_or_ignore, kept_legacy, merge_stats, mint_ids, snapshot_join, upsert
from rollcall.session import load

KEY = ["lok_sabha", "session", "type", "question_no"]
# fixed values: markers of bodies, and what becomes of them
MARKERS = ["empty", "error", "pypdf-empty", "pypdf-error", "ocr-failed", "download-failed"]
RETRYABLE, TERMINAL = ["error", "pypdf-error", "download-failed"], ["empty", "pypdf-empty", "ocr-failed"]


def _crawls(spark, sf_dir):
    """The first crawl of each question, and the crawls after it."""
    q = load(spark, sf_dir, "ls_questions").select(*KEY, "subject", "ministry", "date", F.coalesce("pdf_url", F.lit("")).alias("pdf_url"), "crawled_at")
    first = keep_best(q, KEY, [F.col("crawled_at")])
    last = keep_best(q, KEY, [descending(F.unix_seconds(F.col("crawled_at").cast("timestamp")))])
    later = last.join(first.select(*KEY, F.col("crawled_at").alias("seen")), KEY).where("crawled_at > seen").drop("seen")
    # an old state that lacks the questions of the newest term
    newest = q.agg(F.max("lok_sabha")).first()[0]
    return first.where(F.col("lok_sabha") < newest), later.unionByName(first.where(F.col("lok_sabha") == newest).join(later.select(*KEY), KEY, "left_anti"))


def q_upsert_ls(spark, sf_dir):
    """Fresh records win, none is dropped."""
    old, fresh = _crawls(spark, sf_dir)
    return upsert(old, fresh, KEY).drop("crawled_at")


def q_upsert_guarded(spark, sf_dir):
    """A fresh record without an address never replaces one that has it."""
    old, fresh = _crawls(spark, sf_dir)
    guard = (F.col("n_pdf_url") == "") & (F.col("o_pdf_url") != "")
    return snapshot_join(old, fresh, KEY, guard).select(*KEY, "pdf_url", "origin")


def q_snapshot_join(spark, sf_dir):
    """Full outer join with each record's origin."""
    old, fresh = _crawls(spark, sf_dir)
    return snapshot_join(old, fresh, KEY).select(*KEY, "origin")


def q_kept_legacy(spark, sf_dir):
    """Records by origin; of kept ones those that a walk of their term, session and type did not bring."""
    old, fresh = _crawls(spark, sf_dir)
    scope = ["lok_sabha", "session", "type"]
    return kept_legacy(snapshot_join(old, fresh, KEY), scope, fresh).groupBy(*scope, "origin").agg(F.count("*").alias("n"))


def q_merge_stats(spark, sf_dir):
    """New, updated and kept records of each session."""
    old, fresh = _crawls(spark, sf_dir)
    return merge_stats(snapshot_join(old, fresh, KEY), ["lok_sabha", "session"])


def _marked(spark, sf_dir):
    """Documents with the marker their state stands for."""
    d = load(spark, sf_dir, "documents")
    body = F.trim(F.coalesce("text", F.lit("")))
    marker = F.when(F.col("text").isNull(), F.lit("download-failed")).when(body == "", F.lit("empty")).when(F.length(body) < 40, F.lit("pypdf-error"))
    return d.select("doc_id", "composite_id", "lang", "source", "house", "n_chars", "extracted_at", "text", marker.alias("marker"))


def q_marker_overlay(spark, sf_dir):
    """Markers without those of ids that have a text, zeros kept."""
    d = _marked(spark, sf_dir)
    markers = keep_best(d.where("marker IS NOT NULL").select("composite_id", "marker", "doc_id"), ["composite_id"], [F.col("doc_id")])
    left = markers.join(d.where("marker IS NULL").select("composite_id").distinct(), "composite_id", "left_anti")
    every = spark.createDataFrame([(m,) for m in MARKERS], "marker string")
    return every.join(left.groupBy("marker").agg(F.count("*").alias("n")), "marker", "left").select("marker", F.coalesce("n", F.lit(0)).alias("n"))


def q_shard_overlay(spark, sf_dir):
    """Existing texts under fresh ones, very long ones stored apart."""
    d = load(spark, sf_dir, "documents").where("text IS NOT NULL AND composite_id IS NOT NULL").select("composite_id", "text", "extracted_at", "doc_id")
    old = keep_best(d, ["composite_id"], [F.col("extracted_at"), F.col("doc_id")])
    fresh = keep_best(d, ["composite_id"], [descending(F.unix_seconds(F.col("extracted_at").cast("timestamp"))), F.col("doc_id")])
    state = upsert(old, fresh, ["composite_id"])
    apart = F.octet_length("text") > 10_000
    rows = state.select(keys.shard_file(F.col("composite_id")).alias("file"), apart.alias("apart"), F.when(~apart, F.octet_length("text")).otherwise(0).alias("bytes"))
    return rows.groupBy("file").agg(F.count("*").alias("records"), F.sum(F.col("apart").cast("long")).alias("stored_apart"), F.sum(F.col("bytes").cast("long")).alias("bytes"))


def q_manifest(spark, sf_dir):
    """Records of each house and bucket that have a text in any source."""
    d = load(spark, sf_dir, "documents").where("composite_id IS NOT NULL")
    per = d.groupBy("composite_id").agg(F.max(F.col("text").isNotNull()).alias("has_text"), F.count("*").alias("copies"))
    return per.groupBy(keys.bucket(F.col("composite_id")).alias("bucket")).agg(F.count("*").alias("records"), F.sum(F.col("has_text").cast("long")).alias("with_text"), F.sum("copies").alias("copies"))


def q_audit(spark, sf_dir):
    """Coverage by language, by the first status that holds."""
    status = F.when(F.col("marker").isNull(), "with_text").when(F.col("marker").isin(RETRYABLE), "retryable").when(F.col("marker").isin(TERMINAL), "terminal").otherwise("never_attempted")
    rows = _marked(spark, sf_dir).select(F.coalesce(F.lower("lang"), F.lit("-")).alias("lang"), status.alias("status"))
    return rows.groupBy("lang").agg(*[F.sum((F.col("status") == s).cast("long")).alias(s) for s in ("with_text", "retryable", "terminal")])


def q_audit_versions(spark, sf_dir):
    """Sitting days weighted by their versions."""
    d = load(spark, sf_dir, "rs_debate_days").select("session", F.explode_outer("file_versions").alias("v"))
    return d.groupBy("session").agg(F.count("v.version").alias("versions"), F.sum(F.coalesce((F.trim("v.url") != "").cast("long"), F.lit(0))).alias("with_url"))


def q_queue(spark, sf_dir):
    """Questions without a text or a final marker; starred first, newest first."""
    q = load(spark, sf_dir, "ls_questions").where("coalesce(trim(pdf_url), '') <> ''").select(*KEY).distinct()
    q = q.withColumn("composite_id", F.concat(F.lit("ls|"), keys.ls_question_id(F.col("lok_sabha"), F.col("session"), F.col("type"), F.col("question_no"))))
    d = _marked(spark, sf_dir)
    done = d.where(F.col("marker").isNull() | F.col("marker").isin(TERMINAL)).select("composite_id").distinct()
    retry = d.where(F.col("marker").isin(RETRYABLE)).select("composite_id").distinct().withColumn("tier", F.lit(2))
    todo = q.join(done, "composite_id", "left_anti").join(retry, "composite_id", "left").withColumn("tier", F.coalesce("tier", F.lit(1)))
    order = [F.when(F.upper("type") == "STARRED", 0).otherwise(1), F.col("lok_sabha").desc(), F.col("session").desc(), F.col("question_no").desc(), F.col("type")]
    # a budget for first attempts, a smaller one for those tried before
    first, again = todo.where("tier = 1").orderBy(*order).limit(500), todo.where("tier = 2").orderBy(*order).limit(50)
    return first.union(again).select("composite_id", "tier")


def q_queue_versions(spark, sf_dir):
    """Ingested versions by session, version and day."""
    d = load(spark, sf_dir, "rs_debate_days").where("date_iso IS NOT NULL").select("session", "date_iso", F.explode("file_versions").alias("v")).select("session", "date_iso", "v.version").distinct()
    place = F.when(F.col("version") == "floor", 0).when(F.col("version") == "english", 1).when(F.col("version") == "part1", 2)
    d = d.withColumn("place", place).where("place IS NOT NULL")
    return d.orderBy(F.desc("session"), "place", F.desc("date_iso")).limit(200).select("session", "date_iso", "version")


def q_export_layout(spark, sf_dir):
    """Buckets of the report export and their counts."""
    q = keep_best(load(spark, sf_dir, "ls_questions").select(*KEY, "crawled_at"), KEY, [F.col("crawled_at")])
    return q.groupBy(F.format_string("ls-LS%d-S%d", "lok_sabha", "session").alias("bucket")).agg(F.count("*").alias("records"), F.max("question_no").alias("first_no"))


def q_content_hash(spark, sf_dir):
    """The order-free content hash of each bucket, without volatile columns."""
    q = load(spark, sf_dir, "ls_questions").select("lok_sabha", "session", F.concat_ws("|", "type", "question_no", F.coalesce("subject", F.lit("")), F.coalesce("ministry", F.lit(""))).alias("content")).distinct()
    one = F.conv(F.substring(F.md5("content"), 1, 12), 16, 10).cast("decimal(20,0)")
    return q.groupBy("lok_sabha", "session").agg(F.sum(one).cast("string").alias("content_hash"), F.count("*").alias("records"))


def q_extract_status(spark, sf_dir):
    """Outcomes of extraction by source."""
    m = F.coalesce("marker", F.lit("text"))
    return _marked(spark, sf_dir).groupBy("source", m.alias("status")).agg(F.count("*").alias("n"))


def q_mint_ids(spark, sf_dir):
    """Stable ids; keys of earlier builds keep theirs."""
    p = load(spark, sf_dir, "persons").select("pid", F.regexp_extract("pid", "([0-9]+)$", 1).cast("long").alias("n")).where("n IS NOT NULL").distinct()
    fresh = load(spark, sf_dir, "tcpd_tuples").select("pid")
    return mint_ids(p.groupBy("pid").agg(F.max("n").alias("n")), fresh, "pid", "n")


def q_insert_ignore(spark, sf_dir):
    """Rows whose unique key is not there yet; null keys are distinct."""
    c = load(spark, sf_dir, "tcpd_tuples").select("year", "state_name", "constituency_name", "party", "tuple_id")
    k = ["year", "state_name", "constituency_name", "party"]
    winners = keep_best(load(spark, sf_dir, "tcpd_tuples").where("position = 1").select(*k, "tuple_id"), k, [F.col("tuple_id")])
    return insert_or_ignore(winners, keep_best(c.where("year IS NOT NULL"), k, [F.col("tuple_id")]), k)


QUERIES = {f.__name__: f for f in (q_upsert_ls, q_upsert_guarded, q_snapshot_join, q_kept_legacy, q_merge_stats, q_marker_overlay, q_shard_overlay, q_manifest, q_audit, q_audit_versions, q_queue, q_queue_versions, q_export_layout, q_content_hash, q_extract_status, q_mint_ids, q_insert_ignore)}

from rollcall.plans.scalars import _BUCKET, _GROUP, _LETTER  # noqa: E402

_K = "lok_sabha, session, type, question_no"
_ROW = "subject, ministry, date, pdf_url"
_CRAWLS = f"""q AS (SELECT {_K}, subject, ministry, date, coalesce(pdf_url, '') AS pdf_url, crawled_at FROM ls_questions),
f AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY crawled_at, subject NULLS FIRST, ministry NULLS FIRST, date NULLS FIRST, pdf_url) AS r FROM q) WHERE r = 1),
l AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY crawled_at DESC, subject NULLS FIRST, ministry NULLS FIRST, date NULLS FIRST, pdf_url) AS r FROM q) WHERE r = 1),
m AS (SELECT max(lok_sabha) AS newest FROM q),
old AS (SELECT * FROM f, m WHERE lok_sabha < newest),
fresh AS (SELECT l.* FROM l JOIN f USING (lok_sabha, session, type, question_no) WHERE l.crawled_at > f.crawled_at UNION ALL SELECT f.* FROM f, m WHERE lok_sabha = newest AND NOT EXISTS (SELECT 1 FROM l WHERE l.lok_sabha = f.lok_sabha AND l.session = f.session AND l.type = f.type AND l.question_no = f.question_no AND l.crawled_at > f.crawled_at)),
j AS (SELECT coalesce(o.lok_sabha, n.lok_sabha) AS lok_sabha, coalesce(o.session, n.session) AS session, coalesce(o.type, n.type) AS type, coalesce(o.question_no, n.question_no) AS question_no,
 o.lok_sabha IS NOT NULL AS has_old, n.lok_sabha IS NOT NULL AS has_new, o.subject AS o_subject, n.subject AS n_subject, o.ministry AS o_ministry, n.ministry AS n_ministry, o.date AS o_date, n.date AS n_date, o.pdf_url AS o_pdf_url, n.pdf_url AS n_pdf_url
 FROM old o FULL OUTER JOIN fresh n ON o.lok_sabha = n.lok_sabha AND o.session = n.session AND o.type = n.type AND o.question_no = n.question_no)"""
_ORIGIN = "CASE WHEN NOT has_old THEN 'new' WHEN NOT has_new THEN 'kept' ELSE 'updated' END"
_MARKED = "d AS (SELECT *, CASE WHEN text IS NULL THEN 'download-failed' WHEN trim(text, ' ') = '' THEN 'empty' WHEN length(trim(text, ' ')) < 40 THEN 'pypdf-error' END AS marker FROM documents)"
_MINE = "('error', 'pypdf-error', 'download-failed')"
_END = "('empty', 'pypdf-empty', 'ocr-failed')"
SQL = {
    "q_upsert_ls": f"WITH {_CRAWLS} SELECT {_K}, " + ", ".join(f"CASE WHEN has_new THEN n_{c} ELSE o_{c} END AS {c}" for c in ("subject", "ministry", "date", "pdf_url")) + " FROM j",
    "q_upsert_guarded": f"WITH {_CRAWLS}, g AS (SELECT *, has_old AND has_new AND n_pdf_url = '' AND o_pdf_url <> '' AS guarded FROM j) SELECT {_K}, CASE WHEN NOT has_new OR guarded THEN o_pdf_url ELSE n_pdf_url END AS pdf_url, CASE WHEN NOT has_old THEN 'new' WHEN NOT has_new OR guarded THEN 'kept' ELSE 'updated' END AS origin FROM g",
    "q_snapshot_join": f"WITH {_CRAWLS} SELECT {_K}, {_ORIGIN} AS origin FROM j",
    "q_kept_legacy": f"WITH {_CRAWLS}, o AS (SELECT lok_sabha, session, type, {_ORIGIN} AS origin FROM j), w AS (SELECT DISTINCT lok_sabha, session, type, true AS walked FROM fresh) SELECT lok_sabha, session, type, CASE WHEN origin <> 'kept' THEN origin WHEN walked THEN 'kept_legacy' ELSE 'untouched' END AS origin, count(*) AS n FROM o LEFT JOIN w USING (lok_sabha, session, type) GROUP BY ALL",
    "q_merge_stats": f"WITH {_CRAWLS}, o AS (SELECT lok_sabha, session, {_ORIGIN} AS origin FROM j) SELECT lok_sabha, session, count(*) FILTER (origin = 'new') AS new, count(*) FILTER (origin = 'updated') AS updated, count(*) FILTER (origin = 'kept') AS kept FROM o GROUP BY lok_sabha, session",
    "q_marker_overlay": f"WITH {_MARKED}, m AS (SELECT composite_id, arg_min(marker, doc_id) AS marker FROM d WHERE marker IS NOT NULL GROUP BY composite_id), l AS (SELECT * FROM m WHERE composite_id IS NULL OR composite_id NOT IN (SELECT composite_id FROM d WHERE marker IS NULL AND composite_id IS NOT NULL)) SELECT v.marker, count(l.marker) AS n FROM (VALUES {', '.join(f'({m!r})' for m in MARKERS)}) v(marker) LEFT JOIN l ON l.marker = v.marker GROUP BY v.marker",
    "q_shard_overlay": f"WITH d AS (SELECT composite_id, arg_min(text, {{'a': -epoch_us(extracted_at), 'b': doc_id}}) AS text FROM documents WHERE text IS NOT NULL AND composite_id IS NOT NULL GROUP BY composite_id) SELECT 'texts-' || {_GROUP.format(n=250)} || '.json' AS file, count(*) AS records, count(*) FILTER (strlen(text) > 10000) AS stored_apart, cast(sum(CASE WHEN strlen(text) > 10000 THEN 0 ELSE strlen(text) END) AS BIGINT) AS bytes FROM d GROUP BY 1",
    "q_manifest": f"WITH p AS (SELECT composite_id, bool_or(text IS NOT NULL) AS has_text, count(*) AS copies FROM documents WHERE composite_id IS NOT NULL GROUP BY composite_id) SELECT {_BUCKET} AS bucket, count(*) AS records, count(*) FILTER (has_text) AS with_text, cast(sum(copies) AS BIGINT) AS copies FROM p GROUP BY 1",
    "q_audit": f"WITH {_MARKED} SELECT coalesce(lower(lang), '-') AS lang, count(*) FILTER (marker IS NULL) AS with_text, count(*) FILTER (marker IN {_MINE}) AS retryable, count(*) FILTER (marker IN {_END}) AS terminal FROM d GROUP BY 1",
    "q_audit_versions": "WITH d AS (SELECT session, unnest(CASE WHEN coalesce(len(file_versions), 0) = 0 THEN [NULL] ELSE file_versions END) AS v FROM rs_debate_days) SELECT session, count(v.version) AS versions, count(*) FILTER (trim(v.url) <> '') AS with_url FROM d GROUP BY session",
    "q_queue": f"""WITH {_MARKED}, q AS (SELECT DISTINCT {_K}, 'ls|LS' || lok_sabha || '_S' || session || '_' || {_LETTER} || '_' || question_no AS composite_id FROM ls_questions WHERE coalesce(trim(pdf_url), '') <> ''),
t AS (SELECT q.*, CASE WHEN composite_id IN (SELECT composite_id FROM d WHERE marker IN {_MINE} AND composite_id IS NOT NULL) THEN 2 ELSE 1 END AS tier FROM q WHERE composite_id NOT IN (SELECT composite_id FROM d WHERE (marker IS NULL OR marker IN {_END}) AND composite_id IS NOT NULL)),
r AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY CASE WHEN upper(type) = 'STARRED' THEN 0 ELSE 1 END, lok_sabha DESC, session DESC, question_no DESC, type) AS r FROM t) SELECT composite_id, tier FROM r WHERE r <= CASE tier WHEN 1 THEN 500 ELSE 50 END""",
    "q_queue_versions": "WITH d AS (SELECT session, date_iso, unnest(file_versions).version AS version FROM rs_debate_days WHERE date_iso IS NOT NULL), e AS (SELECT DISTINCT *, CASE version WHEN 'floor' THEN 0 WHEN 'english' THEN 1 WHEN 'part1' THEN 2 END AS place FROM d) SELECT session, date_iso, version FROM e WHERE place IS NOT NULL ORDER BY session DESC, place, date_iso DESC LIMIT 200",
    "q_export_layout": f"SELECT 'ls-LS' || lok_sabha || '-S' || session AS bucket, count(*) AS records, max(question_no) AS first_no FROM (SELECT DISTINCT {_K} FROM ls_questions) GROUP BY 1",
    "q_content_hash": "WITH q AS (SELECT DISTINCT lok_sabha, session, concat_ws('|', type, question_no, coalesce(subject, ''), coalesce(ministry, '')) AS content FROM ls_questions) SELECT lok_sabha, session, cast(sum(cast('0x' || substr(md5(content), 1, 12) AS HUGEINT)) AS VARCHAR) AS content_hash, count(*) AS records FROM q GROUP BY lok_sabha, session",
    "q_extract_status": f"WITH {_MARKED} SELECT source, coalesce(marker, 'text') AS status, count(*) AS n FROM d GROUP BY 1, 2",
    "q_mint_ids": "WITH s AS (SELECT pid, max(try_cast(regexp_extract(pid, '([0-9]+)$', 1) AS BIGINT)) AS n FROM persons GROUP BY pid HAVING n IS NOT NULL), f AS (SELECT DISTINCT pid FROM tcpd_tuples WHERE pid IS NOT NULL AND pid NOT IN (SELECT pid FROM s)) SELECT * FROM s UNION ALL SELECT pid, (SELECT max(n) FROM s) + row_number() OVER (ORDER BY pid) AS n FROM f",
    "q_insert_ignore": "SELECT year, state_name, constituency_name, party, coalesce(min(tuple_id) FILTER (position = 1), min(tuple_id)) AS tuple_id FROM tcpd_tuples WHERE year IS NOT NULL AND state_name IS NOT NULL AND constituency_name IS NOT NULL AND party IS NOT NULL GROUP BY 1, 2, 3, 4 UNION ALL SELECT * FROM (SELECT year, state_name, constituency_name, party, min(tuple_id) FROM tcpd_tuples WHERE year IS NOT NULL AND (state_name IS NULL OR constituency_name IS NULL OR party IS NULL) GROUP BY 1, 2, 3, 4) UNION ALL SELECT * FROM (SELECT year, state_name, constituency_name, party, min(tuple_id) FROM tcpd_tuples WHERE position = 1 AND (year IS NULL OR state_name IS NULL OR constituency_name IS NULL OR party IS NULL) GROUP BY 1, 2, 3, 4)",
}
