"""Repair of text that was read from scanned pages.

Pass one counts, over all documents, the words and the headers that texts repeat. Words
and headers with a fixed share of all, which bounds their number, are broadcast. Pass two
takes each text on its own: page numbers by their sequences, headers by fuzzy repetition at
page edges, split words by the corpus vocabulary, and misread words by a frequent word
one misreading away, which the repaired text has in their place. Where the verdict on a
word depends on its own count and the word is too rare for the broadcast, the line is a
question that a join with the counts of all words answers. What remains is joined into
paragraphs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.pages import Page, Templates, header_masks
from rollcall.session import spill

#: Sources of documents whose texts were read from scanned files.
SCANNED = ("ls_question_pdf", "rs_bundle_pdf", "rs_debate_floor", "rs_debate_english", "committee_scan")
#: Share of all words, and of all repeated headers, from which a word and a header are
#: broadcast: at most a million words and a hundred thousand headers have it.
WORD_SHARE, HEADER_SHARE = 1e-6, 1e-5
#: Words below this count are unknown in any corpus, and so are headers of fewer texts.
LEAST_WORD, LEAST_HEADER = 5, 3

_HYPHENS = "-‐‑–—­¬"
_EDGE = ".,;:()[]{}<>\"'‘’“”?!…*†/=।"
_STRAY = "~^|¦•■□§"
_STRAY_IN = re.compile(rf"[^\W\d_][{re.escape(_STRAY)}]|[{re.escape(_STRAY)}][^\W\d_]")
_CASE = re.compile(r"[a-z][A-Z]|^[a-z]+[A-Z]|[A-Z]{2}[a-z]")
_LATIN, _OTHER = re.compile(r"[A-Za-z]"), re.compile(r"[Ͱ-ӿ]")
_NUMBER = re.compile(r"^[0-9०-९.,:/%-]+$")
_SPLIT_END = re.compile(rf"(?:^|\s)([^\s\d]*[^\W\d_]\w*)[{_HYPHENS}]$")
# fixed values: letters a scanner takes for others, as read and as printed
_MISREAD = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("rn", "m"), ("m", "rn"), ("vv", "w"),
    ("w", "vv"), ("ii", "u"), ("ii", "n"), ("li", "h"), ("cl", "d"), ("d", "cl"), ("ri", "n"), ("ni", "m"), ("in", "m"), ("nn", "m"),
]


class Question(NamedTuple):
    """A verdict that hangs on the count n of a rare word: BAD if value >= factor * n.

    n is the count of key in lower case, at least 1, or of key as it is written, where a
    single one counts as none.
    """

    key: str
    cased: bool
    value: int
    factor: int

    def holds(self, rare: dict[tuple[bool, str], int]) -> bool:
        n = rare.get((self.cased, self.key), 0)
        return self.value >= self.factor * (n if n > 1 else 0 if self.cased else 1)


@dataclass
class Vocabulary:
    """Corpus counts of words without edges, as written and in lower case, and of headers.

    total is the number of all words; without it and lower they are those of words.
    """

    words: dict[str, int]
    templates: dict[str, int]
    lower: dict[str, int] | None = None
    total: int | None = None

    def __post_init__(self) -> None:
        if self.lower is None:
            lower: Counter = Counter()
            for w, n in self.words.items():
                lower[w.lower()] += n
            self.lower = lower
        lower, total = self.lower, sum(self.words.values()) if self.total is None else self.total
        #: from this count a word is never looked at twice
        self.common = max(20, total / 20_000)
        self.floor = least_count(total)
        index: dict[str, list[str]] = {}
        for w, n in lower.items():
            if n >= self.floor and 2 < len(w) <= 24 and w.isalpha() or n >= self.floor and len(w) > 2 and _mostly_letters(w):
                for k in range(len(w)):
                    index.setdefault(w[:k] + w[k + 1 :], []).append(w)
        self.index = index
        self.memo: dict[str, int | Question] = _Memo(self)
        self.fixes: dict[str, str] = _Fixes(self)

    def near(self, word: str) -> tuple[int, str]:
        """The most frequent word one misreading away from word, after its count; (0, "") for none."""
        best, found = 0, ""
        for cut in [word, *(word[:k] + word[k + 1 :] for k in range(len(word)))]:
            # one letter lost, or one letter read as another
            for w in self.index.get(cut, ()):
                if w != word and self.lower[w] > best and _one_apart(word, w):
                    best, found = self.lower[w], w
            # one letter too many
            if cut != word and self.lower.get(cut, 0) > best and len(cut) > 2:
                best, found = self.lower[cut], cut
        for seen, meant in _MISREAD:
            at = word.find(seen)
            while at >= 0:
                w = word[:at] + meant + word[at + len(seen) :]
                if self.lower.get(w, 0) > best:
                    best, found = self.lower[w], w
                at = word.find(seen, at + 1)
        return best, found


def least_count(total: int) -> float:
    return max(LEAST_WORD, total * WORD_SHARE)


def _mostly_letters(w: str) -> bool:
    return not any(c.isdigit() or c in _STRAY for c in w)


def _one_apart(a: str, b: str) -> bool:
    """Equal but for one letter exchanged, lost or added."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return abs(len(a) - len(b)) == 1


FINE, BAD, RARE = 0, 1, 2


class _Memo(dict):
    """What a token is, worked out once for each distinct token of a worker."""

    def __init__(self, v: Vocabulary):
        self.v = v

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[token] = kind = self._kind(token)
        return kind

    def _kind(self, token: str) -> int | Question:
        v, core = self.v, token.strip(_EDGE)
        if not core or _NUMBER.match(core):
            return FINE
        if _STRAY_IN.search(core) or (_LATIN.search(core) and _OTHER.search(core)):
            return BAD
        low = core.lower()
        n = v.lower.get(low)
        if any(c.isdigit() for c in core):
            # digits between letters, or letters within a number
            if re.search(r"[a-z][0-9]|[0-9][a-z]{2}", low) and not re.search(r"^[0-9]+(?:st|nd|rd|th)$", low):
                return self._judge(low, n, v.near(low)[0] - 1, 20) if n is None or n < v.common else RARE
            return FINE if not re.fullmatch(r"[0-9.,]*[lOIo][0-9.,lOIo]*", core) or len(core) < 2 else RARE
        odd_case = core != low and _CASE.search(core)
        if n is not None and n >= v.common:
            if odd_case and not core.isupper() and not core[1:].islower():
                return self._judge_case(core, n, 50, FINE)
            return FINE
        if odd_case and "-" not in core:
            # of two rare counts, the one as written must be more than a single slip
            kind = self._judge_case(core, n, 20, RARE) if n is not None else Question(core, True, 1, 1)
            if kind != RARE:
                return kind
        return self._judge(low, n, v.near(low)[0], 50) if len(core) > 2 else RARE

    def _judge(self, low: str, n: int | None, near: int, factor: int) -> int | Question:
        """BAD where a word one misreading away is factor times as frequent."""
        if near < factor * (n or 1):
            return RARE
        return BAD if n is not None else Question(low, False, near, factor)

    def _judge_case(self, core: str, n: int, factor: int, otherwise: int) -> int | Question:
        """BAD where the word is factor times as frequent as it is in this case."""
        written = self.v.words.get(core)
        if written is None:
            return Question(core, True, n, factor)
        return BAD if n >= factor * written else otherwise


class _Fixes(dict):
    """The word that a misread token stands for, in the token's case and edges; the token where none is known."""

    def __init__(self, v: Vocabulary):
        self.v = v

    def __missing__(self, token: str) -> str:
        if len(self) > 500_000:
            self.clear()
        core = token.strip(_EDGE)
        at = token.find(core)
        self[token] = fixed = token[:at] + self._fixed(core) + token[at + len(core) :]
        return fixed

    def _fixed(self, core: str) -> str:
        v, low = self.v, core.lower()
        n = v.lower.get(low, 0)
        bare = "".join(c for c in low if c not in _STRAY)
        if bare != low:
            # a sign between letters is one too many, or stands for a letter
            best, word = max((v.lower.get(bare, 0), bare), v.near(low))
            if not best:
                best, word = v.near(bare)
            return _in_case(core, word, v) if best else core
        best, word = v.near(low)
        mixed = any(c.isdigit() for c in core) or (_LATIN.search(core) and _OTHER.search(core))
        if best >= 50 * max(1, n) or mixed and best > 20 * max(1, n):
            return _in_case(core, word, v)
        # only the case is wrong, if the word is met in another one
        return _in_case(core, low, v) if not mixed and n > v.words.get(core, 0) else core


def _in_case(core: str, word: str, v: Vocabulary) -> str:
    """word in the case of the token it was read as."""
    letters = [c for c in core if c.isalpha()]
    if sum(c.isupper() for c in letters) > 0.6 * len(letters) and len(letters) > 2:
        return word.upper()
    capital = word[:1].upper() + word[1:]
    if not core[:1].isalpha():
        # the first letter was misread, and with it its case
        return capital if v.words.get(capital, 0) > v.words.get(word, 0) else word
    return capital if core[:1].isupper() else word


def _is_parted(v: Vocabulary, a: str, b: str) -> bool | list[Question]:
    """Whether two tokens are one word with a stray space inside; of questions one must hold."""
    left, right = a.lstrip(_EDGE).lower(), b.rstrip(_EDGE).lower()
    if not left or not right or left[-1] in _EDGE or right[0] in _EDGE or not (left[-1].isalpha() or left[-1] > "ऀ"):
        return False
    whole = v.lower.get(left + right, 0)
    if whole < max(v.floor, 10):
        return False
    rare = [part for part in (left, right) if part not in v.lower]
    if rare:
        return [Question(part, False, whole, 10) for part in rare]
    return whole >= 10 * max(1, min(v.lower[left], v.lower[right]))


def split_words(page: Page, v: Vocabulary) -> dict[int, tuple[int, str]]:
    """Lines whose last word goes on in a later line: line -> (that line, whole word)."""
    out, running = {}, page.running()
    for i, j in zip(running, running[1:]):
        line = page.lines[i]
        if line[-1] not in _HYPHENS or not (m := _SPLIT_END.search(line)):
            continue
        nxt = page.lines[j].split()[0]
        right = re.match(r"[^\W\d_][\w'’ऀ-ॿ]*", nxt)
        if not right:
            continue
        left, right = m[1].lstrip(_EDGE), right[0]
        whole, compound = v.lower.get((left + right).lower(), 0), v.lower.get(f"{left}-{right}".lower(), 0)
        if compound > whole:
            continue
        if not whole and line[-1] == "-":
            # neither is known: two known words are a compound, else a word was split
            a, b = v.lower.get(left.lower(), 0), v.lower.get(right.lower(), 0)
            if min(a, b) >= v.common:
                continue
        out[i] = (j, left + right)
    return out


def _corrected(tokens: list[str], first: int, last: int, v: Vocabulary, rare: dict) -> list[str]:
    """Tokens of a line with misread words replaced and parted ones joined.

    Only tokens from first to before last are words of their own; rare has the counts that
    questions ask for.
    """
    kinds = [k if isinstance(k, int) else BAD if k.holds(rare) else RARE for k in map(v.memo.__getitem__, tokens)]
    if not any(kinds):
        return tokens
    out, joined = [], False
    for k, token in enumerate(tokens):
        inside = first <= k < last
        if inside and not joined and k > first and (kinds[k - 1] or kinds[k]):
            parted = _is_parted(v, tokens[k - 1], token)
            if parted and (parted is True or any(q.holds(rare) for q in parted)):
                out[-1], joined = tokens[k - 1] + token, True
                continue
        joined = False
        bad = kinds[k] == BAD and not (k == len(tokens) - 1 and token[-1] in _HYPHENS)
        out.append(v.fixes[token] if inside and bad else token)
    return out


def misread_lines(page: Page, v: Vocabulary, split: dict[int, tuple[int, str]]) -> dict[int, list[Question]]:
    """Lines of running text with a misread word: those without questions, and those where one must hold."""
    out, kind = {}, v.memo.__getitem__
    halves = {j for j, _ in split.values()}
    for i in page.running():
        tokens = page.lines[i].split()
        kinds = list(map(kind, tokens))
        if not any(kinds):
            continue
        # the two halves of a split word are no words of their own
        first, last = (1 if i in halves else 0), len(tokens) - (1 if i in split else 0)
        asked: list[Question] = []
        for k in range(first, last):
            if kinds[k] == FINE:
                continue
            if kinds[k] != RARE and not (k == len(tokens) - 1 and tokens[k][-1] in _HYPHENS):
                if kinds[k] == BAD:
                    asked = []
                    out[i] = asked
                    break
                asked.append(kinds[k])
            if kinds[k] != BAD:
                found = [_is_parted(v, tokens[j], tokens[j + 1]) for j in (k, k - 1) if first <= j and j + 1 < last]
                if True in found:
                    asked = []
                    out[i] = asked
                    break
                asked += [q for qs in found if qs for q in qs]
        # a half with a sign that belongs to no word is misread all the same
        if out.get(i) != [] and any(_STRAY_IN.search(tokens[k]) for k in (0, len(tokens) - 1)):
            out[i] = []
        elif asked:
            out[i] = asked
    return out


def _read(text: str, v: Vocabulary) -> tuple[Page, dict[int, tuple[int, str]]]:
    """A text's structure, and its split words."""
    page = Page(text)
    page.find_headers(_templates(v))
    return page, split_words(page, v)


def judged_lines(text: str, v: Vocabulary) -> list[tuple[int, str, Question | None]]:
    """(line_no, kind, None) of every line that needs repair, and (line_no, kind, question) of those that may."""
    page, split = _read(text, v)
    out = [(i, "page_no", None) for i in page.numbers] + [(i, "header", None) for i in page.headers]
    out += [(i, "hyphen", None) for i in split]
    for i, asked in misread_lines(page, v, split).items():
        out += [(i, "char", q) for q in dict.fromkeys(asked)] or [(i, "char", None)]
    return out


def line_kinds(text: str, v: Vocabulary, rare: dict = {}) -> list[tuple[int, str]]:  # noqa: B006
    """(line_no, kind) of every line that needs repair, where rare counts what v is too small for."""
    return sorted({(i, kind) for i, kind, q in judged_lines(text, v) if q is None or q.holds(rare)})


def questions(text: str, v: Vocabulary) -> set[tuple[bool, str]]:
    """The words, as written or not, whose counts decide on tokens of a text."""
    return {(q.cased, q.key) for _, _, q in judged_lines(text, v) if q is not None}


def repaired(text: str, v: Vocabulary, rare: dict = {}) -> str:  # noqa: B006
    """The running text in paragraphs, one a line, with split, misread and parted words as they were printed."""
    page, split = _read(text, v)
    paragraphs: list[list[str]] = [[]]
    drop_first: set[int] = set()
    running = page.running()
    after = dict(zip(running, running[1:]))
    previous = None
    for i in running:
        line = page.lines[i]
        if previous is not None:
            gap = any(not page.lines[k] for k in range(previous + 1, i) if k not in page.feeds)
            ended = page.lines[previous].endswith(tuple(".?!।:;)]"))
            indented = page.raw[i][:1] in " \t" and ended
            if (gap and (ended or not line[:1].islower())) or indented:
                paragraphs.append([])
        tokens = line.split()
        tokens = _corrected(tokens, 1 if i in drop_first else 0, len(tokens) - (1 if i in split else 0), v, rare)
        if i in drop_first:
            tokens = tokens[1:]
        previous = i
        if i in split:
            j, whole = split[i]
            rest = page.lines[j].split()[0]
            half = tokens[-1].rstrip(_HYPHENS) if tokens else ""
            word = half + rest
            kind = v.memo[word]
            bad = kind == BAD or isinstance(kind, Question) and kind.holds(rare)
            tokens = [*tokens[:-1], v.fixes[word] if bad else word]
            drop_first.add(j)
        elif tokens and line[-1] in _HYPHENS and i in after and _SPLIT_END.search(line) and (rest := page.lines[after[i]].split()[0])[0].isalpha():
            # a compound broken at its own hyphen
            tokens[-1] += rest
            drop_first.add(after[i])
        paragraphs[-1].extend(tokens)
    return "\n".join(" ".join(p) for p in paragraphs if p)


def _templates(v: Vocabulary) -> Templates:
    if not hasattr(v, "made"):
        v.made = Templates(v.templates)
    return v.made


_worker: dict = {}


def _vocabulary(shared) -> Vocabulary:
    if shared.id not in _worker:
        _worker.clear()
        _worker[shared.id] = Vocabulary(*shared.value)
    return _worker[shared.id]


class _Shared:
    """A broadcast that names itself, so a worker prepares it once."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, broadcast._jbroadcast.id() if broadcast._jbroadcast else id(broadcast)

    @property
    def value(self):
        return self.broadcast.value

    def __reduce__(self):
        return (_rebuild, (self.broadcast, self.id))


def _rebuild(broadcast, key):
    out = _Shared.__new__(_Shared)
    out.broadcast, out.id = broadcast, key
    return out


def corpus_vocabulary(docs: DataFrame, text: str, scanned) -> tuple[_Shared, DataFrame]:
    """The vocabulary of frequent words and headers, broadcast, and the counts (cased, key, n) of all words.

    Words are counted over all documents, headers over scanned ones. Words met once are in no counts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        masks: Counter = Counter()

        def emit() -> pa.RecordBatch:
            bare: Counter = Counter()
            for w, n in words.items():
                if c := w.strip(_EDGE):
                    bare[c] += n
            keys = [*bare, *masks]
            out = {"header": [False] * len(bare) + [True] * len(masks), "key": keys, "n": [*bare.values(), *masks.values()]}
            words.clear()
            masks.clear()
            return pa.RecordBatch.from_pydict(out, pa.schema([("header", pa.bool_()), ("key", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for t in texts:
                if t:
                    words.update(t.split())
            masks += header_masks([t for t, s in zip(texts, batch.column(1).to_pylist()) if s])
            if len(words) > 500_000:
                yield emit()
        yield emit()

    counts = docs.select(F.col(text), scanned.alias("scanned")).mapInArrow(count, "header boolean, key string, n long")
    counts = spill(counts.groupBy("header", "key").agg(F.sum("n").alias("n")))
    totals = {r.header: r.n for r in counts.groupBy("header").agg(F.sum("n").alias("n")).collect()}
    words, headers = counts.where("NOT header").select("key", "n"), counts.where("header").select("key", "n")
    lower = words.groupBy(F.lower("key").alias("key")).agg(F.sum("n").alias("n"))
    total = totals.get(False) or 0

    def frequent(df: DataFrame, least: float) -> dict[str, int]:
        rows = df.where(F.col("n") >= least).toArrow()
        return dict(zip(rows["key"].to_pylist(), rows["n"].to_pylist()))

    templates = frequent(headers, max(LEAST_HEADER, (totals.get(True) or 0) * HEADER_SHARE))
    value = (frequent(words, least_count(total)), templates, frequent(lower, least_count(total)), total)
    every = words.select(F.lit(True).alias("cased"), "key", "n").unionByName(lower.select(F.lit(False).alias("cased"), "key", "n")).where("n > 1")
    return _Shared(docs.sparkSession.sparkContext.broadcast(value)), every


def _is_scanned(source: str, sources) -> F.Column:
    return F.coalesce(F.col(source).isin(list(sources)), F.lit(False)) if sources is not None else F.lit(True)


def noisy_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", sources=SCANNED) -> DataFrame:
    """Rows (doc_id, line_no, kind) of the lines of scanned texts that need repair.

    Words are counted over all rows of docs; lines are looked for in the texts of the
    given sources (None: all). Null, empty and blank texts have no rows. Repeated rows
    give repeated rows. Other columns are ignored; an empty table gives no rows.
    """
    scanned = _is_scanned(source, sources)
    shared, counts = corpus_vocabulary(docs, text, scanned)
    columns = ["row", "doc_id", "line_no", "kind", "key", "cased", "value", "factor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(shared)
        for batch in batches:
            lines, kinds, index, asked = [], [], [], []
            for k, t in enumerate(batch.column(2).to_pylist()):
                for line_no, kind, q in judged_lines(t, v) if t else ():
                    index.append(k)
                    lines.append(line_no)
                    kinds.append(kind)
                    asked.append(q or (None,) * 4)
            at = pa.array(index, pa.int64())
            types = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
            fields = [pa.array([q[i] for q in asked], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.int32()), pa.array(kinds, pa.string()), *fields], columns)

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.where(scanned).select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    judged = spill(rows.mapInArrow(run, f"row long, doc_id {kind}, line_no int, kind string, key string, cased boolean, value long, factor long"))
    asked = judged.where("key IS NOT NULL").join(counts, ["cased", "key"], "left")
    n = F.coalesce("n", F.when(F.col("cased"), 0).otherwise(1))
    asked = asked.where(F.col("value") >= F.col("factor") * n).select("row", "doc_id", "line_no", "kind").distinct()
    return judged.where("key IS NULL").select("doc_id", "line_no", "kind").unionByName(asked.drop("row"))


def readable_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", sources=SCANNED) -> DataFrame:
    """Rows (doc_id, text): each scanned text as paragraphs, one a line.

    Headers and page numbers are gone, split and parted words whole, and misread words
    replaced by the frequent word they stand for, in their case and with their edges; one
    for which no such word is known stays. A null text stays null, an empty one empty.
    """
    scanned = _is_scanned(source, sources)
    shared, counts = corpus_vocabulary(docs, text, scanned)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(shared)
        for batch in batches:
            asked = [(row, *q) for row, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for q in questions(t, v)]
            types = (("row", pa.int64()), ("cased", pa.bool_()), ("key", pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for a in asked], kind) for i, (_, kind) in enumerate(types)], [name for name, _ in types])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(shared)
        for batch in batches:
            out = []
            for t, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out.append(repaired(t, v, {(k["cased"], k["key"]): k["n"] for k in known or ()}) if t else t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    kind = docs.schema[doc_id].dataType.simpleString()
    # written once, so that a row keeps its number
    rows = spill(docs.where(scanned).select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    asked = rows.select("row", "text").mapInArrow(ask, "row long, cased boolean, key string")
    known = asked.join(counts, ["cased", "key"]).groupBy("row").agg(F.collect_list(F.struct("cased", "key", "n")).alias("known"))
    return rows.join(known, "row", "left").select("doc_id", "text", "known").mapInArrow(run, f"doc_id {kind}, text string")
