"""Structure of one text that was read from scanned pages: page numbers and headers.

Plain Python on the lines of one text, called inside Arrow batches.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

_DEVANAGARI = str.maketrans("०१२३४५६७८९", "0123456789")
_MISREAD = str.maketrans("lIOo", "1100")
_PAGE = re.compile(
    r"^([-–—~\[(|.\s]*(?:[Pp][Aa][Gg][Ee]|[Pp][Gg]?)?[-.\s]*)"
    r"([0-9०-९lIOo]{1,4}|[ivx]{1,7})"
    r"(\s*(?:/|[oO][fF])\s*[0-9०-९lIOo]{1,4})?([-–—~\])|.\s]*)$"
)
_LAST = frozenset("0123456789०१२३४५६७८९lIOoivx-–—~])|.")
_ROMAN = {"i": 1, "v": 5, "x": 10}
_MONTH = re.compile(r"(?i)\b(?:january|february|march|april|may|june|july|august|september|october|november|december)\b")
_DIGITS = re.compile(r"[0-9०-९]+")
_EXTRA = re.compile(r"\[[^\]]*\]|\(contd\.?\)|^0 | 0$")
#: Ends of lines after which running text need not go on.
_ENDED = tuple(".?!।;:)]\"”’")


def page_value(line: str) -> tuple[str, int] | None:
    """(form, number) of a line that looks like a page number, else None."""
    m = _PAGE.match(line)
    if not m or not m[2]:
        return None
    left, digits, of, right = m[1].strip().lower(), m[2], m[3], m[4].strip()
    form = f"{left}#{'/' if of else ''}{right}"
    plain = digits.translate(_DEVANAGARI).translate(_MISREAD)
    if plain.isdigit():
        return form, int(plain)
    if set(digits) <= _ROMAN.keys():
        values = [_ROMAN[c] for c in digits]
        return form + "r", sum(-v if v < nxt else v for v, nxt in zip(values, [*values[1:], 0]))
    return None


def mask(line: str) -> str:
    """A line in the form in which running headers repeat: without numbers and months."""
    return " ".join(_MONTH.sub("M", _DIGITS.sub("0", line)).lower().split())


def core(line: str) -> str:
    """The mask of a line without its dates in brackets, page number and (Contd.)."""
    masked = mask(line)
    if "[" in masked or "(" in masked:
        bare = _EXTRA.sub(" ", masked)
        bare = " ".join(bare.split())
        return bare if bare.count(" ") > 0 else masked
    return masked


class Templates:
    """Headers that several texts of the corpus repeat."""

    def __init__(self, counts: dict[str, int]):
        keys = self.keys = set(counts)
        # a header this common is no section title wherever it stands
        most = max(counts.values(), default=0)
        self.common = {k for k, n in counts.items() if n >= 0.1 * most}
        self.lengths = {len(k) for k in keys}
        self.words = {w for k in keys for w in (k.split()[0], k.split()[-1])}

    def candidates(self, lines: list[str]):
        """Lines that may be of a template, by their last word."""
        words = self.words
        for i, line in enumerate(lines):
            if len(line) > 3:
                last = line[line.rfind(" ") + 1 :]
                if last[-1] in "0123456789]).)" or last.lower() in words:
                    yield i


def page_lines(lines: list[str]) -> set[int]:
    """Lines that are only a page number: members of ascending sequences of one form.

    The longest sequence of a form counts, and of the other numbers every sequence that
    starts again. A single number of three digits at most counts when the form is no plain
    number, or when no row of a table of numbers stands beside it; so does a later sequence.
    """
    by_form: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for i, line in enumerate(lines):
        if 0 < len(line) < 24 and line[-1] in _LAST and (found := page_value(line)):
            by_form[found[0]].append((i, found[1]))
    out: set[int] = set()
    for form, hits in by_form.items():
        before: dict[int, int] = {}  # hit -> the hit before it in its sequence
        length: dict[int, tuple[int, int]] = {}  # value -> longest sequence that ends there, and its hit
        for k, (_, v) in enumerate(hits):
            n, last = max((length[v - d] for d in (1, 2, 3) if v - d in length), key=lambda x: x[0], default=(0, -1))
            if n + 1 > length.get(v, (0, -1))[0]:
                length[v] = (n + 1, k)
                before[k] = last
        n, k = max(length.values(), key=lambda x: x[0])
        chain = []
        while k >= 0:
            chain.append(k)
            k = before[k]
        plain = form in ("#", "#.", "#)", "(#)")
        if n > 1 or hits[chain[0]][1] < 1000 and (not plain or form == "#" and not _in_table(lines, hits[chain[0]][0])):
            # years beside one another are a table
            out.update(i for i, v in (hits[k] for k in chain) if v < 1000 or not _in_table(lines, i))
        # every other number goes on with the latest sequence it fits, or begins one
        taken, open_at, chains = set(chain), {}, []
        for k, (i, v) in enumerate(hits):
            if k in taken:
                continue
            c = next((open_at.pop(v - d) for d in (1, 2, 3) if v - d in open_at), None)
            if c is None:
                chains.append(c := [])
            c.append(i)
            open_at[v] = c
        for c in chains:
            if len(c) > 1 and not (plain and any(_in_table(lines, i) for i in c)):
                out.update(c)
    return out


def _beside(lines: list[str], i: int, step: int) -> int | None:
    j = i + step
    while 0 <= j < len(lines) and not lines[j]:
        j += step
    return j if 0 <= j < len(lines) else None


def _in_table(lines: list[str], i: int) -> bool:
    return any((j := _beside(lines, i, s)) is not None and re.fullmatch(r"[0-9][0-9,. ]*", lines[j]) for s in (-1, 1))


class Page:
    """Lines of one text without surrounding white space, and what they are."""

    def __init__(self, text: str):
        self.raw = text.split("\n")
        self.lines = [line.strip(" \t\r\f\v\xa0") for line in self.raw]
        self.feeds = {i for i, line in enumerate(self.raw) if "\f" in line}
        self.numbers = page_lines(self.lines)
        self.headers: set[int] = set()
        lengths = sorted(len(line) for line in self.raw if line.strip())
        self.width = lengths[int(len(lengths) * 0.9)] if lengths else 0
        self.edges = self._edges()

    def _edges(self) -> set[int]:
        """Lines beside a page number, a form feed, or the start or end of the text."""
        lines, marks = self.lines, self.numbers | self.feeds
        out = {j for j in (_beside(lines, -1, 1), _beside(lines, len(lines), -1)) if j is not None}
        for i in marks:
            out.update(j for s in (-1, 1) if (j := _beside(lines, i, s)) is not None)
            if lines[i]:
                out.add(i)
        # the second line of an edge whose first is a page number
        for i in list(out & self.numbers):
            out.update(j for s in (-1, 1) if (j := _beside(lines, i, s)) is not None)
        return out - self.numbers

    def could_be_header(self, i: int) -> bool:
        line = self.lines[i]
        if len(line) < 4 or i in self.numbers or line[0] in "(*.…" or line[-1] in ".;,?:।!-–>" and not line.endswith("(Contd.)"):
            return False
        return not re.search(r"[0-9] [0-9,]+$", line) and any(c.isalpha() for c in line)

    def weight(self, i: int) -> int:
        """How much the place of a line speaks for a header."""
        before, after = self._text_beside(i, -1), self._text_beside(i, 1)
        at_edge = 2 if i in self.edges else 0
        if after is None or before is None:
            return at_edge
        up, down = self.lines[before], self.lines[after]
        open_above = not up.endswith(_ENDED)
        goes_on = down[0].islower() or ("ऀ" <= down[0] <= "ॿ" and open_above)
        if not open_above and goes_on:
            return -3  # the next line goes on from this one
        short = len(self.raw[i].rstrip()) + 1 + len(down.split()[0]) <= self.width
        if open_above and (goes_on or not down[:1].isupper() or i in self.edges):
            # running text is only broken where the next word does not fit
            return at_edge + (2 if short else 0)
        return at_edge if open_above or self.lines[i][:1].isupper() or self.lines[i][:1].isdigit() or self.lines[i][:1] == "[" else at_edge - 1

    def _text_beside(self, i: int, step: int) -> int | None:
        j = _beside(self.lines, i, step)
        while j is not None and (j in self.numbers or j in self.headers):
            j = _beside(self.lines, j, step)
        return j

    def groups(self, only: set[int] | None = None) -> dict[str, list[int]]:
        """Candidate lines by the form in which they repeat."""
        out: dict[str, list[int]] = defaultdict(list)
        for i, line in enumerate(self.lines):
            if line and (only is None or i in only) and self.could_be_header(i):
                out[core(line)].append(i)
        return out

    def repeated_headers(self) -> dict[str, list[int]]:
        """Lines that repeat, but for numbers and months, at places where pages end."""
        # within a text a header keeps its letters, so a cheap key finds what repeats
        seen: dict[bytes, list[int]] = defaultdict(list)
        for i, line in enumerate(self.lines):
            if len(line) > 3 and line[-1] not in ".;,?:।":
                seen[(core(line) if "[" in line or "(" in line else line).encode().translate(None, b"0123456789")].append(i)
        repeated = {i for at in seen.values() if len(at) > 1 for i in at}
        if any("[" in line or "(C" in line for line in self.lines):
            repeated |= {i for i, line in enumerate(self.lines) if "[" in line or "(C" in line or line.isupper()}
        found = {}
        for key, at in self.groups(repeated).items() if repeated else ():
            if len(at) > 1 and sum(max(-2, min(2, self.weight(i))) for i in at) >= len(at):
                found[key] = at
        return found

    def find_headers(self, templates: Templates) -> None:
        """Sets headers: repeated lines, lines of a known template, and misread ones."""
        own = self.repeated_headers()
        for at in own.values():
            self.headers.update(at)
        for i in templates.candidates(self.lines):
            if i not in self.headers and self.could_be_header(i) and core(self.lines[i]) in templates.keys:
                weight, above = self.weight(i), self._text_beside(i, -1)
                common = core(self.lines[i]) in templates.common
                if weight > 0 or weight == 0 and (common or above is not None and not self.lines[above].endswith(_ENDED)):
                    self.headers.add(i)
        if self.headers:
            keys = {core(self.lines[i]) for i in self.headers}
            near = {n + d for i in self.headers for n in (len(self.lines[i]),) for d in range(-3, 4)}
            open_to = {i for i, line in enumerate(self.lines) if i not in self.headers and (i in self.edges or len(line) in near)}
            for key, at in self.groups(open_to).items():
                rest = [i for i in at if self.weight(i) >= (0 if i not in self.edges else 1)]
                if rest and any(abs(len(key) - len(k)) <= 4 and SequenceMatcher(None, key, k).ratio() >= 0.85 for k in keys):
                    self.headers.update(rest)

    def running(self) -> list[int]:
        """Lines of running text in order."""
        return [i for i, line in enumerate(self.lines) if line and i not in self.numbers and i not in self.headers]


def header_masks(texts: list[str | None]) -> Counter:
    """How many of the texts have each repeated header."""
    out: Counter = Counter()
    for t in texts:
        if t and "\n" in t:
            page = Page(t)
            if len(page.lines) > 2:
                out.update(page.repeated_headers().keys())
    return out
