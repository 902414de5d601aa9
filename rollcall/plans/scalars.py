"""Projections and scalar functions (P01-P38, U01) over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.functions import dates, keys, names, places, text, versions
from rollcall.session import load


def q_file_report_key(spark, sf_dir):
    """Ids and pipe keys of all four kinds of records."""
    q, b, d = (load(spark, sf_dir, t) for t in ("ls_questions", "rs_question_bundles", "rs_debate_days"))
    days = d.select("session", "date_iso", F.explode_outer("file_versions").alias("v"))
    return (
        q.select(keys.ls_question_id(F.col("lok_sabha"), F.col("session"), F.col("type"), F.col("question_no")).alias("file_id"), keys.report_key("questions", "ls", F.col("lok_sabha"), F.col("session"), F.upper("type"), F.col("question_no")).alias("report_key"))
        .union(b.select(keys.rs_bundle_id(F.col("session"), F.col("date_iso"), F.col("type")), keys.report_key("questions", "rs", F.col("session"), F.col("date_iso"), F.upper("type"))))
        .union(days.select(keys.rs_day_id(F.col("session"), F.col("date_iso"), F.col("v.version")), keys.report_key("debates", "rs", F.col("session"), F.col("date_iso"), F.col("v.version"))))
    )


def q_bucket_shard_group(spark, sf_dir):
    """Bucket, shard group and file of every composite id."""
    k = F.col("composite_id")
    return load(spark, sf_dir, "documents").select("doc_id", keys.bucket(k).alias("bucket"), keys.shard_group(k).alias("grp"), keys.shard_group(k, keys.SEARCH_STRIDE).alias("search_grp"), keys.shard_file(k).alias("file"))


def q_dates(spark, sf_dir):
    """The four readings of a typed day."""
    dob = F.col("dob")
    return load(spark, sf_dir, "persons").select("rec_id", dates.slash_day(dob).alias("slash"), dates.strict_dob(dob).alias("strict"), dates.lenient_dob(dob).alias("lenient"), dates.sort_key(dob, "/").alias("order_key"))


def q_question_dates(spark, sf_dir):
    """The order keys of dotted days."""
    return load(spark, sf_dir, "ls_questions").select("date", dates.sort_key(F.col("date"), ".").alias("order_key")).distinct()


def q_norm_name(spark, sf_dir):
    """Bag, set, normal form and person key of every person's name."""
    n = F.col("canonical_name")
    return load(spark, sf_dir, "persons").select("rec_id", names.name_bag(n).alias("bag"), names.name_set(n).alias("token_set"), names.normal_form(n).alias("normal"), names.person_key(n).alias("person_key"))


def q_slugs(spark, sf_dir):
    """Slugs, short hashes and genders."""
    n = F.col("canonical_name")
    return load(spark, sf_dir, "persons").select("rec_id", names.slug(n).alias("slug1"), names.name_slug(n).alias("slug2"), F.when(dates.strict_dob(F.col("dob")).isNotNull(), keys.short_hash(F.concat(names.name_bag(n), F.lit("|"), dates.strict_dob(F.col("dob"))))).alias("dob_hash"), names.gender(F.col("gender")).alias("sex"))


def q_places(spark, sf_dir):
    """States, constituencies, their titles, and parties."""
    return load(spark, sf_dir, "tcpd_tuples").select("tuple_id", places.state(F.col("state_name")).alias("state"), places.state_display(F.col("state_name")).alias("state_shown"), places.constituency(F.col("constituency_name")).alias("seat"), places.title_case(F.col("constituency_name")).alias("seat_title"), places.party(F.col("party")).alias("party_code"))


def q_merge_key(spark, sf_dir):
    """P25: the sorted key of all terms of one person."""
    t = load(spark, sf_dir, "tenures").where("external_id IS NOT NULL AND office_type IN ('ls', 'rs')")
    member = F.struct("office_type", F.expr("try_cast(external_id AS BIGINT)").alias("n"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_set(member)), lambda m: F.concat(m["office_type"], F.lit("-"), m["n"])), ",")
    return t.groupBy("pid").agg(F.concat(F.lit("sansad:"), joined).alias("merge_key"))


def q_versions(spark, sf_dir):
    """Version codes, plain addresses, and whether one names its day."""
    d = load(spark, sf_dir, "rs_debate_days").select("session", "date_iso", F.explode("file_versions").alias("v")).select("session", "date_iso", "v.*")
    url = versions.plain_url(F.col("url"))
    return d.select("session", "date_iso", "version", versions.version_code(F.col("version")).alias("code"), url.alias("plain_url"), versions.is_of_day(url, F.col("date_iso")).alias("of_day"))


def q_record_projection(spark, sf_dir):
    """Renamed records with made titles and "a or b" fallbacks."""
    t = load(spark, sf_dir, "tenures")
    filled = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    term = dates.term_number(F.col("term_label"))
    return t.select("id", F.coalesce(filled("constituency"), filled("state"), F.lit("-")).alias("place"), F.coalesce(F.trim("party_short"), F.lit("")).alias("party"), term.alias("term"), dates.term_year(term).alias("year"), F.concat(F.upper("office_type"), F.lit(" "), F.coalesce("term_label", F.lit("?"))).alias("title"))


def q_contest_projection(spark, sf_dir):
    """Contest rows with slugs and won flags; shares of votes are in q_contest_shares."""
    c = load(spark, sf_dir, "tcpd_tuples")
    return c.select("tuple_id", names.slug(F.col("state_name")).alias("state_slug"), names.slug(F.col("constituency_name")).alias("seat_slug"), F.coalesce(F.col("position") == 1, F.lit(False)).alias("won"))


def q_json_props(spark, sf_dir):
    """Values of a JSON text, read with a fixed schema."""
    k = F.from_json("props", "k INT")["k"]
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"), F.count(k).alias("k_count"))


def q_html_strip(spark, sf_dir):
    """Bodies without mark-up, by patterns."""
    return load(spark, sf_dir, "documents").select("doc_id", text.strip_html(F.col("text")).alias("plain"))


def q_tokens(spark, sf_dir):
    """Number of tokens, and heads."""
    t = F.col("text")
    return load(spark, sf_dir, "documents").select("doc_id", F.size(text.tokens(t)).alias("n_tokens"), text.head(t).alias("head"), (F.length(t) > text.HEAD).alias("truncated"))


QUERIES = {f.__name__: f for f in (q_file_report_key, q_bucket_shard_group, q_dates, q_question_dates, q_norm_name, q_slugs, q_places, q_merge_key, q_versions, q_record_projection, q_contest_projection, q_json_props, q_html_strip, q_tokens)}

HON = "'shri','smt','shrimati','dr','ms','mr','mrs','prof','adv','sh','km','kumari'"
TOKENS = f"list_filter(string_split(trim(regexp_replace(regexp_replace(lower({{c}}), '[.,;:()\\[\\]''\"]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda x: x <> '' AND x NOT IN ({HON}))"
BAG = "coalesce(array_to_string(list_sort(" + TOKENS + "), ' '), '')"
SET = "coalesce(array_to_string(list_sort(list_distinct(" + TOKENS + ")), ' '), '')"
_H = r"(?:shri|shrimati|smt\.?|dr\.?|ms\.?|mr\.?|mrs\.?|prof\.?|adv\.?|sh\.?|km\.?)"
NORMAL = (
    "coalesce(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({c}), '^(?:(?:श्री|श्रीमती|डॉ\\.?|डा\\.?|कुमारी|कु\\.?)\\s+)+', ''), "
    + rf"'(?i)^\s*(?:{_H}\s+)+', ''), '(?i)(?:\s+{_H})+\s*$', ''), "
    + "'[.,;:()\\[\\]''\"]', ' ', 'g'), '\\s+', ' ', 'g'))), '')"
)
SLASH = "CASE WHEN regexp_matches({c}, '^\\s*[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}\\s*$') THEN trim(string_split({c}, '/')[3]) || '-' || lpad(string_split({c}, '/')[2], 2, '0') || '-' || lpad(trim(string_split({c}, '/')[1]), 2, '0') END"
STRICT = "CASE WHEN regexp_full_match(trim({c}), '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') THEN regexp_replace(trim({c}), '^(..)/(..)/(....)$', '\\3-\\2-\\1') WHEN regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN trim({c}) END"
SLUG = "coalesce(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '')"
STATE = "(CASE {s} WHEN 'orissa' THEN 'odisha' WHEN 'pondicherry' THEN 'puducherry' WHEN 'nct of delhi' THEN 'delhi' ELSE coalesce({s}, '') END)".format(
    s="trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(lower(state_name), '\\[.*?\\]', ' ', 'g'), '&', ' and '), '[0-9]+', ' ', 'g'), '[^a-z ]+', ' ', 'g'), '\\s+', ' ', 'g'))"
)
_CONS = "trim(regexp_replace(regexp_replace(replace(regexp_replace(lower(trim({c})), '\\(.*?\\)', ' ', 'g'), '&', ' and '), '[^a-z0-9 ]+', ' ', 'g'), '\\s+', ' ', 'g'))"
CONS = "coalesce(map_extract(map {{{{{pairs}}}}}, {c})[1], {c}, '')".format(pairs=", ".join(f"'{a}': '{b}'" for a, b in places.CONSTITUENCY_ALIASES.items()), c=_CONS)
PARTY = "regexp_replace(upper(trim(coalesce({c}, ''))), '\\.+$', '')"
_TITLE = "array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), lambda w: upper(w[1]) || lower(w[2:])), '')"
_SEAT = r"'^(.*?)\s*\(([^)]+)\)\s*$'"
TITLE = f"CASE WHEN regexp_matches({{s}}, {_SEAT}) THEN {_TITLE.format(x=f'regexp_extract({{s}}, {_SEAT}, 1)')} || ' (' || upper(regexp_extract({{s}}, {_SEAT}, 2)) || ')' ELSE {_TITLE.format(x='{s}')} END".format(s="nullif(trim(constituency_name), '')")
_BUCKET = """coalesce(nullif(regexp_replace(array_to_string(list_filter(list_concat([CASE WHEN contains(composite_id, '|') THEN split_part(composite_id, '|', 1) ELSE '' END],
 list_filter(regexp_split_to_array(CASE WHEN contains(composite_id, '|') THEN regexp_replace(composite_id, '^[^|]*\\|', '') ELSE composite_id END, '[_|]'), lambda x: x <> '')[1:2]), lambda x: x <> ''), '-'), '[^A-Za-z0-9-]', '', 'g'), ''), 'misc')"""
_NUM = "try_cast(nullif(regexp_extract(composite_id, '([0-9]+)[^0-9]*$', 1), '') AS BIGINT)"
_GROUP = f"CASE WHEN {_NUM} IS NULL THEN {_BUCKET} ELSE {_BUCKET} || '-' || printf('%04d', {_NUM} // {{n}}) END"
_LETTER = "CASE WHEN upper(type) = 'STARRED' THEN 'S' ELSE 'U' END"

SQL = {
    "q_file_report_key": f"""
SELECT 'LS' || lok_sabha || '_S' || session || '_' || {_LETTER} || '_' || question_no AS file_id, concat_ws('|', 'questions', 'ls', lok_sabha, session, upper(type), question_no) AS report_key FROM ls_questions
UNION ALL SELECT 'RS' || session || '_' || date_iso || '_' || {_LETTER}, concat_ws('|', 'questions', 'rs', session, date_iso, upper(type)) FROM rs_question_bundles
UNION ALL SELECT 'RS' || session || '_' || date_iso || CASE WHEN v.version IS NULL THEN '' ELSE '_' || v.version END, concat_ws('|', 'debates', 'rs', session, date_iso, v.version)
FROM (SELECT session, date_iso, unnest(CASE WHEN coalesce(len(file_versions), 0) = 0 THEN [NULL] ELSE file_versions END) AS v FROM rs_debate_days)""",
    "q_bucket_shard_group": f"SELECT doc_id, {_BUCKET} AS bucket, {_GROUP.format(n=250)} AS grp, {_GROUP.format(n=1000)} AS search_grp, 'texts-' || {_GROUP.format(n=250)} || '.json' AS file FROM documents",
    "q_dates": f"""SELECT rec_id, {SLASH.format(c="dob")} AS slash, {STRICT.format(c="dob")} AS strict,
coalesce({SLASH.format(c="trim(dob)")}, CASE WHEN regexp_full_match(trim(dob), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN string_split(trim(dob), '-')[1] || '-' || lpad(string_split(trim(dob), '-')[2], 2, '0') || '-' || lpad(string_split(trim(dob), '-')[3], 2, '0') END, nullif(trim(dob), '')) AS lenient,
CASE WHEN len(string_split(dob, '/')) = 3 THEN string_split(dob, '/')[3] || '-' || string_split(dob, '/')[2] || '-' || string_split(dob, '/')[1] ELSE coalesce(dob, '') END AS order_key FROM persons""",
    "q_question_dates": "SELECT DISTINCT date, CASE WHEN len(string_split(date, '.')) = 3 THEN string_split(date, '.')[3] || '-' || string_split(date, '.')[2] || '-' || string_split(date, '.')[1] ELSE coalesce(date, '') END AS order_key FROM ls_questions",
    "q_norm_name": f"""SELECT rec_id, {BAG.format(c="canonical_name")} AS bag, {SET.format(c="canonical_name")} AS token_set, {NORMAL.format(c="canonical_name")} AS normal,
coalesce(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(canonical_name), '^([^,]+),\\s*(.+)$', '\\2 \\1'), '(?i)^\\s*{_H}\\s+', ''), '(?i)\\s+{_H}\\s*$', ''), '[^a-zA-Z0-9\\s]+', ' ', 'g'), '\\s+', ' ', 'g'))), '') AS person_key FROM persons""",
    "q_slugs": f"""SELECT rec_id, {SLUG.format(c="canonical_name")} AS slug1,
coalesce(nullif(regexp_replace(regexp_replace(array_to_string({TOKENS.format(c="canonical_name")}, '-'), '[^a-z0-9-]+', '-', 'g'), '^-+|-+$', '', 'g'), ''), 'anon') AS slug2,
CASE WHEN {STRICT.format(c="dob")} IS NOT NULL THEN substr(sha256({BAG.format(c="canonical_name")} || '|' || {STRICT.format(c="dob")}), 1, 16) END AS dob_hash,
CASE upper(trim(gender)) WHEN 'MALE' THEN 'M' WHEN 'FEMALE' THEN 'F' ELSE nullif(upper(trim(gender)), '') END AS sex FROM persons""",
    "q_places": f"SELECT tuple_id, {STATE} AS state, coalesce(trim(regexp_replace(regexp_replace(state_name, '\\[.*?\\]', '', 'g'), '[0-9]+$', '')), '') AS state_shown, {CONS.format(c='constituency_name')} AS seat, {TITLE} AS seat_title, {PARTY.format(c='party')} AS party_code FROM tcpd_tuples",
    "q_merge_key": "SELECT pid, 'sansad:' || array_to_string(list_transform(list_sort(list(DISTINCT {'a': office_type, 'n': try_cast(external_id AS BIGINT)})), lambda m: m.a || '-' || m.n), ',') AS merge_key FROM tenures WHERE external_id IS NOT NULL AND office_type IN ('ls', 'rs') GROUP BY pid",
    "q_versions": """WITH d AS (SELECT session, date_iso, unnest(file_versions) AS v FROM rs_debate_days), e AS (SELECT session, date_iso, v.version AS version, replace(v.url, '\\', '/') AS plain_url, substr(date_iso, 1, 4) AS y, substr(date_iso, 6, 2) AS m, substr(date_iso, 9, 2) AS d FROM d)
SELECT session, date_iso, version, CASE WHEN lower(trim(version)) LIKE 'floor%' THEN 'floor' WHEN lower(trim(version)) LIKE 'english%' THEN 'english' WHEN regexp_matches(lower(trim(version)), '^part ?-?1') THEN 'part1' END AS code, plain_url,
coalesce((contains(plain_url, y || m || d) OR contains(plain_url, d || m || y) OR contains(plain_url, ltrim(d, '0') || m || y) OR contains(plain_url, ltrim(d, '0') || ltrim(m, '0') || y) OR contains(plain_url, d || '.' || m || '.' || y)) AND plain_url <> '', false) AS of_day FROM e""",
    "q_record_projection": """WITH t AS (SELECT *, CASE WHEN regexp_full_match(term_label, 'LS[0-9]+') THEN cast(substr(term_label, 3) AS INT) END AS term FROM tenures)
SELECT id, coalesce(nullif(trim(constituency), ''), nullif(trim(state), ''), '-') AS place, coalesce(trim(party_short), '') AS party, term, CASE term WHEN 14 THEN 2004 WHEN 15 THEN 2009 WHEN 16 THEN 2014 WHEN 17 THEN 2019 WHEN 18 THEN 2024 END AS year, upper(office_type) || ' ' || coalesce(term_label, '?') AS title FROM t""",
    "q_contest_projection": f"SELECT tuple_id, {SLUG.format(c='state_name')} AS state_slug, {SLUG.format(c='constituency_name')} AS seat_slug, coalesce(position = 1, false) AS won FROM tcpd_tuples",
    "q_json_props": "SELECT event_type, cast(sum(cast(json_extract(props, '$.k') AS INT)) AS BIGINT) AS k_sum, count(cast(json_extract(props, '$.k') AS INT)) AS k_count FROM events GROUP BY event_type",
    "q_html_strip": """SELECT doc_id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\\n[ \\t]*\\n[ \\t\\n]*', chr(10) || chr(10), 'g'), '^[ \\t\\n]+|[ \\t\\n]+$', '', 'g') AS plain FROM documents""",
    "q_tokens": "SELECT doc_id, len(regexp_extract_all(lower(text), '[a-z0-9]{3,}'))::INT AS n_tokens, substring(text, 1, 5000) AS head, length(text) > 5000 AS truncated FROM documents",
}
