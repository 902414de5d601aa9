"""Free-text names to persons: exact form first, then the most alike form."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.functions import names
from rollcall.session import cut

#: Forms that one task compares with at a time; it takes a quarter of that of typed ones.
BLOCK = 1 << 15
#: Forms of one token that give a first score, counts of a letter told apart in a bound, and pairs compared in a row.
LEADS, LEVELS, PAIRS = 256, 4, 1 << 13


def lookup(persons: DataFrame, pid: str, name: str) -> DataFrame:
    """Rows (form, pids, pid): each normal form with the number and the least of its pids."""
    forms = persons.select(F.col(pid).alias("pid"), names.normal_form(F.col(name)).alias("form")).where("form <> '' AND pid IS NOT NULL")
    return forms.groupBy("form").agg(F.count_distinct("pid").alias("pids"), F.min("pid").alias("pid"))


def lookup_in_house(raw: DataFrame, forms: DataFrame, house: str) -> DataFrame:
    """Rows (raw, pid, status) of raw names whose normal form is a person's.

    forms has form, pid and house. exact: one pid has the form; exact_house: several, of
    which one in the house; else ambiguous_exact, without pid. Names nobody has give no row.
    """
    inside = F.when(F.col("house") == house, F.col("pid"))
    per = forms.where("form <> '' AND pid IS NOT NULL").groupBy("form").agg(F.count_distinct("pid").alias("pids"), F.min("pid").alias("pid"), F.count_distinct(inside).alias("inside"), F.min(inside).alias("in_pid"))
    named = raw.select("raw").distinct().withColumn("form", names.normal_form(F.col("raw"))).join(per, "form")
    status = F.when(F.col("pids") == 1, "exact").when(F.col("inside") == 1, "exact_house").otherwise("ambiguous_exact")
    return named.select("raw", F.when(F.col("pids") == 1, F.col("pid")).when(F.col("inside") == 1, F.col("in_pid")).alias("pid"), status.alias("status"))


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len a + len b), by bit-parallel rows."""
    if not a and not b:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    for c in b:
        u = row & masks.get(c, 0)
        row = (row + u | row - u) & (1 << len(a)) - 1
    return 200.0 * (len(a) - row.bit_count()) / (len(a) + len(b))


class FormBlock:
    """Forms laid out so that many strings are compared with all of them at once."""

    def __init__(self, forms: list[str]):
        self.forms = forms
        often = Counter("".join(forms))
        self.codes = {c: k for k, c in enumerate(sorted(often, key=lambda c: (-often[c], c)), 1)}
        self.letters, self.lengths, self.counts = self._laid_out(forms)
        #: Letters halved in three ways; how many of each half two strings have bounds what they share.
        self.halves = [(np.arange(len(self.codes) + 1) >> b) % 2 for b in range(3)]
        self.levels = np.minimum(self.counts.max(axis=1, initial=0), LEVELS + 1)
        self.levels[0] = 0
        self.features = np.hstack([self._levels(self.counts, True), self.lengths[:, None], np.ones((len(forms), 1))]).astype(np.float32)

    def _laid_out(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(f) for f in strings], np.int64)
        letters = np.zeros((len(strings), max(lengths, default=0)), np.int32)
        for row, f in zip(letters, strings):
            row[: len(f)] = [self.codes.get(c, 0) for c in f]
        counts = np.zeros((len(self.codes) + 1, len(strings)), np.int32)
        for column in letters.T:
            np.add.at(counts, (column, np.arange(len(strings))), 1)
        counts[0] = 0
        return letters, lengths, counts

    def _levels(self, counts: np.ndarray, known: bool) -> np.ndarray:
        """Numbers by string whose products with those of the other side sum to no less than the letters both have."""
        out = [np.zeros(counts.shape[1], np.float32)]
        for k in np.flatnonzero(self.levels):
            out += [counts[k] >= n for n in range(1, min(self.levels[k], LEVELS) + 1)]
            if self.levels[k] > LEVELS:
                out.append(counts[k] > LEVELS if known else np.maximum(counts[k] - LEVELS, 0))
        return np.array(out, np.float32).T

    def masks(self, letters: np.ndarray) -> np.ndarray:
        """By string and letter, the places of the letter in the string's first 64."""
        out = np.zeros((len(letters), len(self.codes) + 1), np.uint64)
        for i, column in enumerate(letters.T[:64]):
            out[np.arange(len(letters)), column] |= np.uint64(1 << i)
        out[:, 0] = 0
        return out

    def ratios(self, typed: list[str], size: np.ndarray, masks: np.ndarray, q: np.ndarray, f: np.ndarray) -> np.ndarray:
        """indel_ratio of typed[q] and forms[f], pair by pair; size and masks are those of typed."""
        out = np.zeros(len(q))
        long = size[q] > 64
        out[long] = [indel_ratio(typed[i], self.forms[j]) for i, j in zip(q[long], f[long])]
        short = np.flatnonzero(~long)
        short = short[np.argsort(np.minimum(self.lengths[f[short]], 1 << 14).astype(np.int16), kind="stable")]
        flat, width = masks.ravel(), masks.shape[1]
        for at in (short[k : k + PAIRS] for k in range(0, len(short), PAIRS)):
            i, j = q[at], f[at]
            full = np.uint64(2**64 - 1) >> (64 - np.maximum(size[i], 1)).astype(np.uint64)
            full[size[i] == 0] = 0
            row, base = full.copy(), i * width
            for column in np.ascontiguousarray(self.letters[j, : self.lengths[j].max()].T):
                u = flat.take(base + column)
                u &= row
                left = row - u
                row += u
                row |= left
            out[at] = 200.0 * (size[i] - np.bitwise_count(row & full).astype(np.int64)) / np.maximum(size[i] + self.lengths[j], 1)
            out[at[size[i] + self.lengths[j] == 0]] = 100.0
        return out

    def best(self, typed: list[str], least: np.ndarray, group: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(q, f, ratio): of each string the forms with its greatest indel_ratio, unless that is below least.

        Strings that reach a ratio differ in few letters, in all and in each half, and have
        most letters in common, so only such pairs are compared; none that may be best is left out.
        """
        letters, size, counts = self._laid_out(typed)
        least = np.array(least, float)
        features, masks = self._levels(counts, False), self.masks(letters)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

        def compare(q: np.ndarray, f: np.ndarray) -> None:
            ratio = self.ratios(typed, size, masks, q, f)
            np.maximum.at(least, q, ratio)
            found.append((q[ratio >= least[q]], f[ratio >= least[q]], ratio[ratio >= least[q]]))

        few = min(16, len(self.forms))
        unknown = np.flatnonzero(least <= 0)
        for at in (unknown[k : k + group] for k in range(0, len(unknown), group)):
            bound = features[at] @ self.features[:, :-2].T / np.maximum(size[at][:, None] + self.lengths, 1)
            top = np.argpartition(-bound, few - 1, axis=1)[:, :few]
            compare(np.repeat(at, few), top.ravel())
        ours, theirs = ([(side @ c, (1 - side) @ c) for side in self.halves] for c in (counts, self.counts))
        order = np.lexsort((*(x for x, _ in reversed(ours)), size, least // 4))
        for at in (order[k : k + group] for k in range(0, len(order), group)):
            may = (1 - least[at].min() / 100) * (size[at].max() + self.lengths) + 1e-6  # letters that need not be shared
            near = np.maximum(size[at].min() - self.lengths, self.lengths - size[at].max()) <= may
            apart = lambda mine, other: np.maximum(0, np.maximum(mine[at].min() - other, other - mine[at].max()))
            for (x, y), (u, v) in zip(ours, theirs):
                near &= apart(x, u) + apart(y, v) <= may
            near = np.flatnonzero(near)
            for some in (near[k : k + PAIRS] for k in range(0, len(near), PAIRS)):
                share = (least[at] / 200)[:, None]
                spare = np.hstack([features[at], -share, -share * size[at][:, None]]).astype(np.float32) @ self.features[some].T
                i, j = np.divmod(np.flatnonzero(spare.ravel() >= -1e-3), len(some))
                for k in range(0, len(i), 8 * PAIRS):
                    compare(at[i[k : k + 8 * PAIRS]], some[j[k : k + 8 * PAIRS]])
        q, f, ratio = (np.concatenate(x) for x in zip(*found))
        kept = np.unique(np.stack([q, f])[:, ratio == least[q]], axis=1)
        return kept[0], kept[1], least[kept[0]]


def _first_scores(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (key, least) of keys that share a token with a form: a ratio that some form has.

    Of the two rarest tokens a key shares, up to LEADS forms are looked at. It is where the
    comparison with all forms begins, and leaves nothing out of it.
    """
    tokens = lambda df: df.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("token"))
    known = tokens(right.select("key").distinct())
    held = known.groupBy("token").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("n", "token"))
    ours = tokens(left.select("key").distinct()).join(held, "token").withColumn("rank", rank).where("rank <= 2").select("key", "token")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64("token"), F.lit(4 * parts)).cast("int").alias("bucket")

    def compare(typed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known[known["token"].isin(set(typed["token"]))]
        known = known[known.groupby("token").cumcount() < LEADS]
        if not len(known):
            return pd.DataFrame({"key": [], "least": []}).astype({"key": str, "least": float})
        strings, forms = sorted(set(typed["key"])), sorted(set(known["key"]))
        block = FormBlock(forms)
        pairs = typed.assign(q=np.searchsorted(strings, typed["key"].tolist())).merge(known.assign(f=np.searchsorted(forms, known["key"].tolist())), on="token")
        letters, size, _ = block._laid_out(strings)
        ratio = block.ratios(strings, size, block.masks(letters), pairs["q"].to_numpy(), pairs["f"].to_numpy())
        best = pd.Series(ratio).groupby(pairs["q"].to_numpy()).max()
        return pd.DataFrame({"key": [strings[i] for i in best.index], "least": best.to_numpy()})

    scores = ours.withColumn("bucket", bucket).groupBy("bucket").cogroup(known.withColumn("bucket", bucket).groupBy("bucket")).applyInPandas(compare, "key string, least double")
    return scores.groupBy("key").agg(F.max("least").alias("least"))


def best_forms(rest: DataFrame, forms: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (form, other, score): for each form of rest the most alike ones of all forms.

    Every form is held against every other, a block of each side at a time, so what a
    task holds is bounded; forms alike to the same degree all stay within a block.
    """
    sort = lambda c: F.array_join(F.array_sort(F.split(c, " ")), " ")
    left = cut(rest.select("form").distinct().withColumn("key", sort(F.col("form"))))
    right = cut(forms.select("form").distinct().withColumn("key", sort(F.col("form"))))
    n, b = left.count(), -(-right.count() // block) or 1
    tasks = 2 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = max(-(-n // max(block // 4, 16)), min(-(-n // 512), -(-tasks // b))) or 1
    left = cut(left.join(_first_scores(left, right), "key", "left").select("form", "key", F.coalesce("least", F.lit(0.0)).alias("least")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.withColumn("i", F.pmod(F.xxhash64("form"), F.lit(a)).cast("int")).withColumn("j", every(b))
    right = right.withColumn("j", F.pmod(F.xxhash64("form"), F.lit(b)).cast("int")).withColumn("i", every(a))

    def compare(typed: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(known) and len(typed):
            spelt: dict[str, list[str]] = {}
            for form, key in zip(known["form"], known["key"]):
                spelt.setdefault(key, []).append(form)
            forms, typed_forms = FormBlock(list(spelt)), typed["form"].tolist()
            for q, f, score in zip(*forms.best(typed["key"].tolist(), typed["least"].to_numpy())):
                out += [(typed_forms[q], other, float(score)) for other in spelt[forms.forms[f]]]
        return pd.DataFrame(out, columns=["form", "other", "score"])

    return left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInPandas(compare, "form string, other string, score double")


def resolve(spelled: DataFrame, forms: DataFrame, least: float = 92.0, block: int = BLOCK) -> DataFrame:
    """Rows (raw, pid, status, score) of each distinct raw name.

    exact and ambiguous_exact come from an equi-join. Of the rest each takes the best of
    all forms by the ratio of sorted tokens; two shared tokens lift a lower ratio to 100.
    fuzzy_high needs 95 or two shared tokens, else review; none is unmatched.
    """
    raw = spelled.select("raw").distinct().withColumn("form", names.normal_form(F.col("raw")))
    exact = raw.join(forms, "form", "left")
    done = exact.where("pid IS NOT NULL OR form = ''")
    status = F.when(F.col("form") == "", "empty").when(F.col("pids") == 1, "exact").otherwise("ambiguous_exact")
    first = done.select("raw", F.when(F.col("pids") == 1, F.col("pid")).alias("pid"), status.alias("status"), F.when(F.col("form") == "", 0).otherwise(100).alias("score"))
    rest = exact.where("pid IS NULL AND form <> ''").select("raw", "form")
    scored = best_forms(rest, forms, block).withColumn("shared", names.shared_tokens(F.col("form"), F.col("other")))
    best = scored.groupBy("form").agg(F.max(F.struct("score", "shared", "other")).alias("b")).select("form", "b.*")
    best = best.join(forms.select(F.col("form").alias("other"), "pids", "pid"), "other").withColumn("score", F.when((F.col("score") < least) & (F.col("shared") >= 2), 100.0).otherwise(F.col("score")))
    sure = (F.col("score") >= 95) | (F.col("shared") >= 2)
    kind = F.when(F.col("score").isNull() | (F.col("score") < least), "unmatched").when(~sure, "review").when(F.col("pids") == 1, "fuzzy_high").otherwise("ambiguous_fuzzy")
    second = rest.join(best, "form", "left").select("raw", F.when((F.col("score") >= least) & (F.col("pids") == 1), F.col("pid")).alias("pid"), kind.alias("status"), F.coalesce(F.floor("score"), F.lit(0)).cast("int").alias("score"))
    return first.union(second)
