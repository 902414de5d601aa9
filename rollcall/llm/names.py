"""Names typed by people: their parts, and the person each spelling stands for.

Every canonical rewriting of a name is generated by rules (forms of address and legal forms
dropped, order of parts, given names as initials or nicknames, middle names left out, parts
that no one bears mended to parts that someone bears) and the forms of spellings and persons
are equi-joined. A rewriting is scored by its rarity: how seldom spellings need its rules,
learned from all spellings. Of the least rare rewritings that meet anyone, only one that
meets a single person links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.truth import TITLES
from rollcall.session import cut, spill

# fixed values: decorations that are no part of a name
_DECORATIONS = ["mp", "m.p", "mla", "m.l.a", "retd", "alias"]
# fixed values: legal forms of organisations
LEGAL_FORMS = ["ltd", "limited", "pvt", "private", "llp", "inc", "plc", "corp", "gmbh"]
# fixed values: letters with marks, and what they are without
_MARKED, _BARE = "āīūēōṛṣśṭḍṇñṅṃḥãâáàäéèêíìîóòôöúùûüç", "aiueorsstdnnnmhaaaaaeeeiiioooouuuuc"
#: Rewritings of one spelling made in a row; of spellings with more, only those that meet a person are made.
MOST_IN_ROW = 256
# fixed values: endings of nicknames after the beginning of a given name
NICKNAME_ENDINGS = ["u", "oo", "ji", "i", "y"]
#: Letters of a given name that a nickname keeps, and what stands for the ending in a form, as no part has it.
NICKNAME_LETTERS, MARK = range(2, 6), "*"
_NICKNAME = rf"^.{{1,{max(NICKNAME_LETTERS)}}}(?:{'|'.join(NICKNAME_ENDINGS)})$"


def parts(name: Column) -> Column:
    """Lower-case parts of a typed name in the order "given names, surname".

    Brackets, quoted nicknames, "alias ..." and forms of address are dropped, marks taken
    off letters and hyphens closed; "Surname, Given" is turned round. Initials are parts
    of one letter.
    """
    # initials written together: before a name in ordinary capitals any two, else no form of address
    s = F.regexp_replace(name, r"\b(\p{Lu})(\p{Lu})\b(?=\s+\p{Lu}\p{Ll})", "$1 $2")
    s = F.regexp_replace(s, r"\b(?!(?:DR|MS|MR|MP)\b)(\p{Lu})(\p{Lu})\b(?=\s)", "$1 $2")
    s = F.translate(F.lower(s), _MARKED, _BARE)
    s = F.regexp_replace(s, r"[\s  ]+", " ")
    s = F.regexp_replace(s, r"\([^)]*\)|\"[^\"]*\"|“[^”]*”|'[^']*'| alias .*$|, *m\.? ?p\.? *$|, *m\.? ?l\.? ?a\.? *$", " ")
    s = F.regexp_replace(s, r"^\s*([^,]+?)\s*,\s*(.+)$", "$2 $1")
    s = F.regexp_replace(F.regexp_replace(s, r"[-‐‑–'’]", ""), r"[^\p{L}\p{M}]+", " ")
    return F.filter(F.split(F.trim(s), " "), lambda p: (p != "") & ~p.isin([*TITLES, *_DECORATIONS, *LEGAL_FORMS]))


def person_names(persons: DataFrame) -> DataFrame:
    """Rows (pid, name ARRAY): the most complete name of each pid.

    Of names with as many written-out parts the one wins that more rows of the pid have
    and whose rarest part more pids bear. Pids without a name have no row.
    """
    rows = persons.select("pid", parts(F.col("canonical_name")).alias("name")).where("pid IS NOT NULL AND size(name) > 0")
    votes = cut(rows.groupBy("pid", "name").agg(F.count("*").alias("votes")))
    borne = votes.select("pid", "name", "votes", F.explode("name").alias("part"))
    pids = borne.groupBy("part").agg(F.count_distinct("pid").alias("pids"))
    rarest = borne.join(pids.hint("merge"), "part").groupBy("pid", "name", "votes").agg(F.min("pids").alias("rarest"))
    written = F.size(F.filter("name", lambda p: F.length(p) > 1))
    score = F.struct(written.alias("w"), (F.col("votes") + F.log("rarest")).alias("s"), F.col("name"))
    best = rarest.groupBy("pid").agg(F.max(score).alias("best"))
    return best.select("pid", F.col("best.name").alias("name"))


def _spread(df: DataFrame, key: str) -> DataFrame:
    """df over as many tasks as a shuffle has: what a small table is exploded to is no longer small."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _bag(*of: Column) -> Column:
    return F.array_join(F.sort_array(F.concat(*of)), " ")


def person_forms(names: DataFrame) -> DataFrame:
    """Rows (form, cost, pid): each way to write a person's name, at its least cost.

    A nickname's ending is not written out: a MARK stands for any of NICKNAME_ENDINGS, and
    spelling_forms has it too. Only where a nickname may be a part of the same name are all
    written out, so that what the name itself gives keeps its own cost.
    """
    given, last = F.slice("name", 1, F.size("name") - 1), F.array(F.element_at("name", -1))
    first, middle = F.slice(given, 1, 1), F.slice(given, 2, F.size("name"))
    one, closed = F.element_at("name", 1), F.array_join(given, "")
    short = lambda a: F.transform(a, lambda p: F.substring(p, 1, 1))
    initials = short(middle)
    # written-out given names with and without the middle ones, then initials, then nicknames
    costs = [[_bag(given, last)], [_bag(first, last), _bag(F.array(closed), last), _bag(first, initials, last)], [_bag(short(first), middle, last), _bag(short(given), last), _bag(short(first), last)]]
    nick = lambda ending: [_bag(F.array(F.concat(F.substring(one, 1, k), F.lit(ending))), *of) for k in NICKNAME_LETTERS for of in ([last], [middle, last], [initials, last])]
    own = F.exists(F.concat("name", F.array(closed)), lambda p: p.rlike(_NICKNAME) & p.startswith(F.substring(one, 1, min(NICKNAME_LETTERS))))
    every = F.flatten(F.array(*(F.array(*nick(e)) for e in NICKNAME_ENDINGS)))
    costs = [*(F.array(*of) for of in costs), F.when(own, every).otherwise(F.array(*nick(MARK)))]
    alone = lambda k: F.array(_bag(F.col("name"))) if k == 0 else F.array().cast("array<string>")
    forms = names.select("pid", *(F.when(F.size("name") > 1, c).otherwise(alone(k)).alias(f"f{k}") for k, c in enumerate(costs)))
    cheaper = lambda k: F.concat(*(F.col(f"f{i}") for i in range(k)))
    rows = forms.select("pid", F.explode(F.array(*(F.struct(F.lit(k).alias("cost"), (F.array_except(f"f{k}", cheaper(k)) if k else F.col("f0")).alias("forms")) for k in range(len(costs))))).alias("x"))
    return rows.select("pid", F.explode("x.forms").alias("form"), F.col("x.cost").alias("cost")).select("pid", "form", "cost")


def _marked(token: Column) -> Column:
    """A part as the nickname it may be, its ending marked: no, one or several strings."""
    ways = F.array(*(F.when(token.endswith(e) & F.length(token).between(len(e) + 1, len(e) + max(NICKNAME_LETTERS)), F.concat(F.substring(token, F.lit(1), F.length(token) - len(e)), F.lit(MARK))) for e in NICKNAME_ENDINGS))
    return F.when(token.rlike(_NICKNAME), F.array_compact(ways)).otherwise(F.array().cast("array<string>"))


def _with_marks(name: Column) -> Column:
    """The name, and the name with one of its parts marked."""
    one = lambda t, i: F.transform(_marked(t), lambda m: F.concat(F.slice(name, F.lit(1), i), F.array(m), F.slice(name, i + 2, F.size(name))))
    return F.concat(F.array(name), F.flatten(F.transform(name, one)))


def _cuts(token: Column) -> Column:
    """A part, and the part without each of its letters."""
    return F.array_distinct(F.concat(F.array(token), F.transform(F.sequence(F.lit(1), F.length(token)), lambda k: F.concat(F.substring(token, F.lit(1), k - 1), F.substring(token, k + 1, F.length(token))))))


def _sound(token: Column) -> Column:
    """A part as it sounds: long vowels short, doubled letters single, v for w."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "ee", "i"), "oo", "u"), "w", "v")
    return F.concat(F.lit("~"), F.regexp_replace(s, r"(.)\1+", "$1"))


def _one_slip(a: Column, b: Column) -> Column:
    """One letter more, less or other, or two neighbours exchanged."""
    d = F.levenshtein(a, b)
    return (d == 1) | ((d == 2) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))))


def mended(tokens: DataFrame, borne: DataFrame) -> DataFrame:
    """Rows (token, mends ARRAY): for parts no one bears, the borne parts one slip away or of one sound.

    tokens and borne have token. How often a part was typed says nothing: one slip in a
    common name is common. Borne parts and those of up to three letters are as meant.
    """
    odd = tokens.where(F.length("token") > 3).select("token").distinct().join(borne.hint("merge"), "token", "left_anti")
    keys = lambda c: F.explode(F.concat(_cuts(c), F.array(_sound(c))))
    left = odd.select("token", keys(F.col("token")).alias("c"))
    right = borne.where(F.length("token") > 3).select(F.col("token").alias("borne"), keys(F.col("token")).alias("c"))
    # a few times as many rows as the names have parts, which no estimate knows: never broadcast
    pairs = left.join(right.hint("merge"), "c").where(_one_slip(F.col("token"), F.col("borne")) | (_sound(F.col("token")) == _sound(F.col("borne")))).select("token", "borne").distinct()
    return pairs.groupBy("token").agg(F.sort_array(F.collect_set("borne")).alias("mends"))


def _products(choices: Column) -> Column:
    """Every way to choose one (token, slip) of each list of choices, as (name, slips)."""
    none = F.array(F.struct(F.array().cast("array<string>").alias("name"), F.lit(0).alias("slips")))
    return F.aggregate(
        choices, none,
        lambda acc, choice: F.flatten(F.transform(acc, lambda a: F.transform(choice, lambda c: F.struct(F.concat(a["name"], F.array(c["token"])).alias("name"), (a["slips"] + c["slip"]).alias("slips"))))),
    )


def spelling_forms(spellings: DataFrame, names: DataFrame, known_forms: DataFrame | None = None, most_in_row: int = MOST_IN_ROW) -> DataFrame:
    """Rows (spelling, form, slips): the rewritings of each distinct spelling.

    Of a spelling with more than most_in_row rewritings only those among the forms of names
    are made (of known_forms, if given, with the column form): the part that fewest forms
    have leads to forms, and each form keeps the choices it has, so nothing that meets a
    person is lost.
    """
    typed = spill(_spread(spellings.select("spelling"), "spelling").select("spelling", parts(F.col("spelling")).alias("name")).where("size(name) > 0"))
    closed = F.array_join(F.slice("name", 1, F.size("name") - 1), "")  # given names without a space
    borne = names.select(F.explode(F.concat("name", F.array(closed))).alias("token")).where(F.length("token") > 1).distinct()
    at = typed.select("spelling", F.posexplode("name").alias("k", "token"))
    # two neighbouring parts no one bears may be one part with a space inside
    joined = typed.where("size(name) > 1").select("spelling", "name", F.explode(F.transform(F.sequence(F.lit(1), F.size("name") - 1), lambda k: F.struct(k.alias("k"), F.concat(F.get("name", k - 1), F.get("name", k)).alias("token")))).alias("x")).select("spelling", "name", "x.k", "x.token")
    joined = joined.join(borne.hint("merge"), "token", "left_semi").select(
        "spelling", F.concat(F.slice("name", F.lit(1), F.col("k") - 1), F.array("token"), F.slice("name", F.col("k") + 2, F.size("name"))).alias("name"), F.lit(1).alias("slips")
    )
    joined = joined.select("spelling", F.explode(_with_marks(F.col("name"))).alias("name"), "slips")
    choices = at.join(mended(at.select("token").distinct(), borne), "token", "left")
    # an odd part stays as a choice of its own: it may be a nickname
    choice = F.concat(F.array(F.struct("token", F.lit(0).alias("slip"))), F.transform(F.coalesce("mends", F.array().cast("array<string>")), lambda t: F.struct(t.alias("token"), F.lit(1).alias("slip"))))
    marks = F.flatten(F.transform(choice, lambda c: F.transform(_marked(c["token"]), lambda m: F.struct(m.alias("token"), c["slip"].alias("slip")))))
    choice = F.concat(choice, marks)
    choices = choices.groupBy("spelling").agg(F.sort_array(F.collect_list(F.struct("k", choice.alias("choice")))).alias("all"))
    ways = F.aggregate("all", F.lit(1.0), lambda acc, x: acc * F.size(x["choice"]))
    choices = spill(choices.select("spelling", F.transform("all", lambda x: x["choice"]).alias("all"), ways.alias("ways")))
    rewritten = choices.where(F.col("ways") <= most_in_row).select("spelling", F.explode(_products(F.col("all"))).alias("x")).select("spelling", "x.name", "x.slips")
    many = _many_ways(choices.where(F.col("ways") > most_in_row), names, known_forms)
    rows = rewritten.unionByName(joined).unionByName(many)
    return rows.select("spelling", _bag(F.col("name")).alias("form"), "slips").groupBy("spelling", "form").agg(F.min("slips").alias("slips"))


def _many_ways(choices: DataFrame, names: DataFrame, known_forms: DataFrame | None) -> DataFrame:
    """Rows (spelling, name, slips) of the rewritings that are among the forms."""
    each = choices.select("spelling", F.posexplode("all").alias("k", "choice")).select("spelling", "k", F.explode("choice").alias("c")).select("spelling", "k", "c.token")
    if known_forms is None:  # every form of a person has the last part of the name
        known_forms = person_forms(names.withColumn("token", F.element_at("name", -1)).join(each.select("token").distinct(), "token", "left_semi"))
    have = cut(known_forms.select("form").distinct()).select("form", F.split("form", " ").alias("tokens"))
    by_token = have.select("form", "tokens", F.explode(F.array_distinct("tokens")).alias("token"))
    borne_by = by_token.groupBy("token").agg(F.count("*").alias("forms"))
    # a form must have a token of every part, so the part with the fewest forms finds them all
    reach = each.join(borne_by, "token", "left").groupBy("spelling", "k").agg(F.sum(F.coalesce("forms", F.lit(0))).alias("forms"))
    anchor = reach.groupBy("spelling").agg(F.min(F.struct("forms", "k")).alias("a")).where("a.forms > 0").select("spelling", "a.k")
    met = each.join(anchor, ["spelling", "k"]).join(by_token, "token").select("spelling", "form", "tokens").distinct()
    met = met.join(choices, "spelling").where(F.size("tokens") == F.size("all"))
    kept = F.transform("all", lambda choice: F.filter(choice, lambda c: F.array_contains(F.col("tokens"), c["token"])))
    rows = met.select("spelling", "form", F.explode(_products(kept)).alias("x")).select("spelling", "form", "x.name", "x.slips")
    return rows.where(_bag(F.col("name")) == F.col("form")).select("spelling", "name", "slips")


def link_spellings(spellings: DataFrame, persons: DataFrame) -> DataFrame:
    """Rows (spelling, pid) of each distinct spelling that stands for one person.

    spellings has a string column spelling; nulls, blanks and strings without letters
    stand for nobody. A form is first cut down to one row with the number of its
    persons, so a form that many share never makes pairs. Of a spelling's rewritings the
    least rare that meet anyone count; when those meet more than one person, the spelling
    links to nobody.
    """
    names = cut(person_names(persons))
    # one shuffle by form serves the counts and the join; what the names are exploded to is never broadcast
    forms = _spread(person_forms(_spread(names, "pid")), "form").groupBy("form", "cost").agg(F.count("*").alias("pids"), F.min("pid").alias("pid"))
    typed = spelling_forms(spellings.select("spelling").where("spelling IS NOT NULL").distinct(), names)
    hits = spill(typed.join(forms.hint("merge"), "form").select("spelling", "slips", "cost", "pids", "pid"))
    scored = hits.join(F.broadcast(rarities(hits)), ["slips", "cost"])  # a row for each set of rules
    best = scored.groupBy("spelling", "rarity").agg(F.max("pids").alias("pids"), F.min("pid").alias("pid"), F.max("pid").alias("other"))
    best = best.groupBy("spelling").agg(F.min(F.struct("rarity", "pids", "pid", "other")).alias("b")).select("spelling", "b.*")
    return best.where("pids = 1 AND pid = other").select("spelling", "pid")


def rarities(hits: DataFrame) -> DataFrame:
    """Rows (slips, cost, rarity): bits of surprise that a spelling needs these rules at least.

    A rewriting with more slips is never less rare than one with fewer and the same rules.
    """
    needed = hits.groupBy("spelling").agg(F.min(F.struct((F.col("slips") * 10 + F.col("cost")).alias("total"), "slips", "cost")).alias("b")).select("b.slips", "b.cost")
    counted = hits.select("slips", "cost").distinct().join(needed.groupBy("slips", "cost").agg(F.count("*").alias("n")), ["slips", "cost"], "left")
    so_far = Window.partitionBy("cost").orderBy("slips")
    # one row for each number of slips and set of rules, so a window over one partition is small
    all_ = F.sum(F.coalesce("n", F.lit(0)) + 1).over(Window.partitionBy())
    counted = counted.withColumn("own", -F.log2((F.coalesce("n", F.lit(0)) + 1) / all_))
    return counted.select("slips", "cost", F.max("own").over(so_far).alias("rarity"))
