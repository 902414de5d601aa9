"""Texts cut off by field limits or broken transfers, found in pure SQL.

Words are runs without white space, with numbers as 0. Each trigram of
all texts is counted where it stands inside a text, and where it ends one. A text is
cut when its final trigram is at home inside texts and almost never ends one, or when
its last word is only the beginning of words that follow the same two words elsewhere.
"Almost never" is a share of all occurrences, with a bound for chance, so it does not
depend on how many texts there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import cut, spill

#: Share of a trigram's occurrences that may end texts, if it is no ending.
MOST_TERMINAL = 0.005
#: Standard deviations by which chance may raise the number of ends above that share (one in twenty).
CHANCE = 1.64
#: Share of a trigram's occurrences that may end texts, this one with them, if the full stop or
#: bracket at its end does not close a sentence.
ABBREVIATION = 0.005
#: Letters of a word that a join on beginnings compares first.
_KEY = 40

# the words of whole texts; only their trigrams leave this step
_WORDS = r"""
SELECT w, greatest(size(w) - 3, 0) AS n
FROM (SELECT filter(split(regexp_replace(text, '[0-9०-९]+', '0'), '\\s+'), x -> x <> '') AS w FROM {docs})
"""

# white space and marks are taken off the end by position, so long texts are read once;
# only where the last 64 characters are nothing else, all of the text is searched
_ENDINGS = r"""
SELECT doc_id, source, text, tail RLIKE '{mark}$' AS marked,
       CASE WHEN bare = tail THEN t WHEN bare = '' THEN regexp_replace(t, '(?<![\\s…])(?:\\s|{mark})+$', '') ELSE left(t, length(t) - length(tail) + length(bare)) END AS body
FROM (SELECT *, regexp_replace(tail, '(?:\\s|{mark})+$', '') AS bare
      FROM (SELECT *, right(t, 64) AS tail FROM (SELECT doc_id, source, text, trim(TRAILING '{white}' FROM text) AS t FROM {docs})))
"""

# of the last eight runs between white space three words are taken; where they hold fewer, of all
_FINALS = r"""
SELECT doc_id, source, text_hash, marked, body, last_line, size(w) AS n, runs,
       coalesce(regexp_replace(try_element_at(w, -3), '[0-9०-९]+', '0'), '') AS w1, coalesce(regexp_replace(try_element_at(w, -2), '[0-9०-९]+', '0'), '') AS w2,
       coalesce(regexp_replace(try_element_at(w, -1), '[0-9०-९]+', '0'), '') AS w3
FROM (
  SELECT doc_id, source, text_hash, marked, right(body, 1) AS body, last_line, runs,
         CASE WHEN size(near) > 3 OR spaced = last_runs THEN near ELSE filter(split(spaced, ' +'), x -> x <> '') END AS w
  FROM (SELECT *, filter(split(last_runs, ' '), x -> x <> '') AS near,
               coalesce(CASE WHEN NOT body RLIKE '[.?!।]$' AND length(last_line) > 3
                    THEN contains(regexp_replace(text, '[0-9०-९]+', '0'), concat('\n', regexp_replace(last_line, '[0-9०-९]+', '0'), '\n')) END, false) AS runs
        FROM (SELECT *, substring_index(spaced, ' ', -8) AS last_runs
              FROM (SELECT *, translate(body, '{white}', '      ') AS spaced, substring_index(body, '\n', -1) AS last_line, md5(text) AS text_hash FROM {endings})))
)
"""
_MARK = r"(?:…|�|(?<=[^.)\\s])\\.\\.\\.|\\[(?:\\.\\.\\.|…|cut|truncated|more)\\])"
_WHITE = r" \t\n\r\u000b\u000c"

# OUTER keeps the planner from splitting the words once more for a filter
_INSIDE = """
SELECT w1, w2, w3, count(*) AS inside
FROM (SELECT x.w1, x.w2, x.w3 FROM {words} LATERAL VIEW OUTER inline(arrays_zip(slice(w, 1, n), slice(w, 2, n), slice(w, 3, n))) x AS w1, w2, w3)
GROUP BY w1, w2, w3 HAVING w3 IS NOT NULL
"""

# a text extracted twice ends once
_ENDS = "SELECT w1, w2, w3, count(DISTINCT text_hash) AS ends FROM {words} WHERE n >= 3 GROUP BY 1, 2, 3"

_EXACT = """
SELECT e.*, coalesce(i.inside, 0) AS inside
FROM {ends} e LEFT JOIN {inside} i ON e.w1 = i.w1 AND e.w2 = i.w2 AND e.w3 = i.w3
"""

# other texts that may end alike by chance, if the trigram is no ending
_ALLOWED = "({n} * {most} + {chance} * sqrt({n} * {most}))"
# inside alone does not decide
_OPEN = "(inside = 0 OR ends - 1 > {allowed})"

# words that follow the same two words and begin with the last; each word is exploded to its
# beginnings, so no pairs arise within two words, and of two long beginnings the rest is compared
_EVIDENCE = """
SELECT e.w1, e.w2, e.w3, first(e.ends) AS ends, first(e.inside) AS inside, coalesce(sum(l.inside), 0) AS longer
FROM {exact} e LEFT JOIN (
  SELECT w1, w2, w3, inside, left(w3, k) AS beginning
  FROM (SELECT i.* FROM {inside} i LEFT SEMI JOIN (SELECT w1, w2 FROM {exact} WHERE {open}) u ON i.w1 = u.w1 AND i.w2 = u.w2)
  LATERAL VIEW OUTER explode(sequence(1, least(length(w3) - 1, {key}))) AS k
  WHERE length(w3) > 1
) l ON {open_e} AND e.w1 = l.w1 AND e.w2 = l.w2 AND left(e.w3, {key}) = l.beginning AND length(l.w3) > length(e.w3) AND startswith(l.w3, e.w3)
GROUP BY e.w1, e.w2, e.w3
"""

# last words that no text has after the same two words, as words and as beginnings anywhere
_BEGINNINGS = """
SELECT u.w3, sum(CASE WHEN u.w3 = b.word THEN b.n ELSE 0 END) AS as_word, sum(CASE WHEN u.w3 <> b.word THEN b.n ELSE 0 END) AS as_beginning
FROM (SELECT DISTINCT w3 FROM {evidence} WHERE inside = 0 AND longer = 0 AND w3 <> '') u
JOIN (SELECT word, n, left(word, k) AS beginning
      FROM (SELECT w3 AS word, sum(inside) AS n FROM {inside} GROUP BY w3) LATERAL VIEW OUTER explode(sequence(1, least(length(word), {key}))) AS k) b
  ON left(u.w3, {key}) = b.beginning AND startswith(b.word, u.w3)
GROUP BY u.w3
"""

_PAGE_LINE = r"^\\s*[-~\\[(]*\\s*(?:page|p|pg)?[-. ]*(?:[0-9०-९]+[0-9lOoI]*|[lOI][0-9lOI]*|[ivxlcdm]+)\\s*(?:(?:/|of)\\s*[0-9lOI]+)?\\s*[-~\\])]*\\s*$"

_CUT = (
    r"""
SELECT d.doc_id, d.source,
       coalesce(CASE
         WHEN d.n < 3 THEN false
         WHEN d.marked AND NOT d.body RLIKE '[.?!।॥]$' THEN true
         WHEN d.last_line RLIKE '(?i)"""
    + _PAGE_LINE
    + r"""' THEN false
         WHEN d.last_line RLIKE '^\\s*[0-9]+\\s+\\[|\\]\\s*[0-9]+$' THEN false
         WHEN d.runs OR (d.w2 RLIKE '^[0,.]+$' AND d.w3 RLIKE '^[0,.]+$') THEN false
         WHEN NOT d.last_line RLIKE '[\\p{{Ll}}\\p{{Lo}}]' THEN d.last_line RLIKE '\\p{{Lu}}{{2}}' AND e.inside = 0 AND e.longer > 0 AND e.ends - 1 <= {longer}
         WHEN d.body RLIKE '[?!।॥]$' THEN false
         WHEN d.body RLIKE '[)\\]}}>"\'”’]$' OR d.w3 RLIKE '^\\p{{L}}{{1,4}}\\.$' THEN e.ends <= e.inside * {abbreviation}
         WHEN d.body RLIKE '\\.$' THEN false
         WHEN e.inside > 0 THEN e.ends - 1 <= {both}
         WHEN e.longer > 0 THEN e.ends - 1 <= {longer}
         ELSE e.ends = 1 AND b.as_beginning > 0 AND b.as_word <= b.as_beginning * {most}
       END, false) AS is_cut
FROM {finals} d LEFT JOIN {evidence} e ON d.w1 = e.w1 AND d.w2 = e.w2 AND d.w3 = e.w3
LEFT JOIN {beginnings} b ON d.w3 = b.w3
"""
)


def truncated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", most_terminal: float = MOST_TERMINAL, abbreviation: float = ABBREVIATION, chance: float = CHANCE) -> DataFrame:
    """Rows (doc_id, source, is_cut) of every row of docs.

    A null, empty or blank text and one of fewer than three words is never cut, nor is
    one that ends with a line that is only a page number, two
    numbers, or a line that the text repeats.
    A mark of omission at the end is ignored. Repeated rows stay repeated; other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    names = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    fill = lambda sql, **values: [sql := sql.replace("{" + k + "}", str(v)) for k, v in values.items()][-1]
    allowed = lambda n: fill(_ALLOWED, n=n, most=most_terminal, chance=chance)
    # the last words of each text are a narrow table that two later steps read
    endings = spark.sql(fill(_ENDINGS, mark=_MARK, white=_WHITE), docs=names)
    finals = cut(spark.sql(fill(_FINALS, white=_WHITE), endings=endings))
    ends = spark.sql(_ENDS, words=finals)
    # counted once, read by both kinds of evidence
    inside = spill(spark.sql(_INSIDE, words=spark.sql(_WORDS, docs=names)))
    exact = cut(spark.sql(_EXACT, ends=ends, inside=inside))
    undecided = fill(_OPEN, allowed=allowed("inside"))
    in_e = undecided.replace("inside", "e.inside").replace("ends", "e.ends")
    evidence = cut(spark.sql(fill(_EVIDENCE, open=undecided, open_e=in_e, key=_KEY), exact=exact, inside=inside))
    beginnings = spark.sql(fill(_BEGINNINGS, key=_KEY), evidence=evidence, inside=inside)
    sql = fill(_CUT, most=most_terminal, abbreviation=abbreviation, longer=allowed("e.longer"), both=allowed("(e.inside + e.longer)"))
    return spark.sql(sql, finals=finals, evidence=evidence, beginnings=beginnings)


def truncation_rates(marked: DataFrame) -> DataFrame:
    """Rows (source, documents, cut, rate) from the rows of truncated()."""
    return marked.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum(F.col("is_cut").cast("long")).alias("cut"),
        F.round(F.avg(F.col("is_cut").cast("double")), 6).alias("rate"),
    )
