import random

from rollcall.llm.pages import Page, Templates, page_lines, page_value
from rollcall.llm.scans import Vocabulary, line_kinds, noisy_lines, questions, readable_texts, repaired
from rollcall.llm.truncation import truncated, truncation_rates

DOCS = "doc_id long, text string, source string, kind string, w string"
WORDS = "the committee examined proposal of government released funds under scheme and utilisation certificates were furnished by states".split()


def scan(pages: int, seed: int) -> tuple[str, dict[int, str]]:
    """A text with known noise, and its noisy lines."""
    r, lines, noise = random.Random(seed), [], {}
    for p in range(3, 3 + pages):
        noise[len(lines)] = "header"
        lines.append(f"Written Answers [{seed % 28 + 1} March, 2001] to Questions")
        noise[len(lines)] = "page_no"
        lines.append(f"- {p} -")
        for _ in range(6):
            words = [r.choice(WORDS) for _ in range(8)]
            lines.append(" ".join(words))
        k = len(lines)
        noise[k] = "hyphen"
        some = lambda n: " ".join(r.choice(WORDS) for _ in range(n))
        lines += [f"{some(5)} the utili-", f"sation of funds {some(5)}"]
        noise[k + 2] = "char"
        word = r.choice([w for w in WORDS if len(w) > 6])
        at = r.randint(2, len(word) - 2)
        miscased = word[:at] + word[at].upper() + word[at + 1 :]
        lines += [f"{some(3)} govern~ment {some(4)}", f"{some(3)} {miscased if p % 2 else word} {some(3)}"]
        if p % 2:
            noise[k + 3] = "char"
    return "\n".join(lines), noise


def test_known_noise_is_found(spark):
    docs, want = [], set()
    for i in range(60):
        text, noise = scan(3, i)
        docs.append((i, text, "rs_bundle_pdf", "x", "y"))
        want |= {(i, k, v) for k, v in noise.items()}
    docs += [(100 + i, " ".join(WORDS * 30) + " with", "ls_debate_html", None, None) for i in range(20)]
    docs += [(200, None, "rs_bundle_pdf", None, None), (201, "", "rs_bundle_pdf", None, None), (202, " \n ", "rs_bundle_pdf", None, None)]
    df = spark.createDataFrame(docs, DOCS)
    got = {tuple(r) for r in noisy_lines(df).collect()}
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.03 * len(want)
    texts = {r.doc_id: r.text for r in readable_texts(df).collect()}
    assert texts[200] is None and texts[201] == "" and "utilisation of funds" in texts[0] and "Written Answers" not in texts[0]
    assert noisy_lines(df.limit(0)).collect() == []


def test_page_numbers():
    assert page_value("~ 12 ~")[1] == 12 and page_value("l3")[1] == 13 and page_value("xiv")[1] == 14 and page_value("Page 3 of 9")[1] == 3 and page_value("- ११ -")[1] == 11
    assert page_value("46310") is None and page_value("word") is None
    lines = ["8", "text", "46310", "48195", "", "9", "more", "10"]
    assert page_lines(lines) == {0, 5, 7}
    assert page_lines(["12", "13000", "a"]) == set()
    again = [x for n in (1, 2, 3, 4, 5, 1, 2, 3) for x in (str(n), "running text")]
    assert page_lines(again) == set(range(0, 16, 2))
    assert page_lines(["1201", "text", "1202", "text", "1203"]) == {0, 2, 4} and page_lines(["2001", "text"]) == page_lines(["2001", "2002", "2003"]) == set()


def test_long_headers():
    header = "Written Answers of the House of the People to Starred and Unstarred Questions, with the Correction of earlier Answers"
    page = Page("\n".join(x for n, w in ((1, "first"), (2, "second"), (3, "third")) for x in (header, str(n), f"the {w} page goes on with running text that does not", f"end as {w} pages do but reaches over to what follows and")))
    page.find_headers(Templates({}))
    assert len(header) > 100 and page.headers == {0, 4, 8}


def test_rare_words_are_asked_for():
    v = Vocabulary({"scheme": 90_000, "funds": 4_000_000}, {}, {"scheme": 90_000, "funds": 4_000_000}, 10_000_000)
    text = "funds of the scherne"
    assert questions(text, v) == {(False, "scherne")}
    assert line_kinds(text, v) == line_kinds(text, v, {(False, "scherne"): 1800}) == [(0, "char")] and repaired(text, v) == "funds of the scheme"
    assert line_kinds(text, v, {(False, "scherne"): 1801}) == [] and repaired(text, v, {(False, "scherne"): 1801}) == text


def test_headers_and_words_have_no_cap(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4)) + "ation"
    docs = [(i, f"{word(i)} {word(i)} proposal", "rs_bundle_pdf", None, None) for i in range(3000)] + [(9000 + i, "the proposa1 of " + word(i), "rs_bundle_pdf", None, None) for i in range(5)]
    df = spark.createDataFrame(docs, DOCS)
    assert {tuple(r) for r in noisy_lines(df).collect()} == {(9000 + i, 0, "char") for i in range(5)}
    assert {r.text for r in readable_texts(df).where("doc_id >= 9000").collect()} == {"the proposal of " + word(i) for i in range(5)}


def test_compounds_are_no_split_words():
    v = Vocabulary({"non-official": 50, "official": 80, "non": 5, "outlay": 60, "centres": 30, "set": 90, "approved": 90}, {})
    text = "to set up non-\nofficial centres and the approved out-\nlay was set"
    assert line_kinds(text, v) == [(1, "hyphen")]
    assert repaired(text, v) == "to set up non-official centres and the approved outlay was set"


def test_body_lines_that_repeat_are_no_headers():
    page = Page("Monitoring is done at 4 levels, and the reports are compiled\nevery quarter. So it is.\nMonitoring is done at 9 levels, and the reports are compiled\nevery quarter. So it is.")
    page.find_headers(Templates({}))
    assert page.headers == set()


def test_cut_texts(spark):
    r = random.Random(4)
    sentences = ["The committee examined the revised proposal of the state government in detail.", "Funds were released to the district administration under the national canal scheme.", "The House was informed that several schools have been repaired in the first phase.", "No such proposal is under consideration at present."]
    rows, cut_ids = [], set()
    for i in range(400):
        body = " ".join(r.choice(sentences) for _ in range(12)) + " "
        if i % 4 == 0:
            s = r.choice(sentences)
            at = r.randint(20, len(s) - 9)
            while s[at - 1] == " " or at > len(s) - 5:
                at -= 1
            rows.append((i, body + s[:at] + ("…" if i % 8 == 0 else ""), "a", None, None))
            cut_ids.add(i)
        else:
            rows.append((i, body + r.choice(["", "\n\nNEW DELHI;\n4 May, 2001", "\n\n(Placed at Annexure II)", "\n\nAnnexure: Nil", "\n\nSPECIAL MENTIONS", "\n- 7 -"]), "b", None, None))
    rows += [(900, None, "c", None, None), (901, "", "c", None, None), (902, "two words", "c", None, None), (903, "   ", None, None, None)]
    df = spark.createDataFrame(rows, DOCS)
    marked = truncated(df)
    found = {x.doc_id for x in marked.where("is_cut").collect()}
    assert marked.count() == len(rows) and len(found & cut_ids) >= 0.95 * len(cut_ids) and not found - cut_ids
    rates = {x.source: x for x in truncation_rates(marked).collect()}
    assert rates["b"].cut == 0 and rates["a"].rate >= 0.95 and rates["c"].documents == 3 and rates[None].documents == 1
    assert truncated(df.limit(0)).collect() == []


def test_equal_cuts_and_long_ends(spark):
    sentence = "The committee examined the revised proposal of the state government in detail."
    rows = [(i, f"Item {chr(97 + i % 26)}{chr(97 + i // 26)}. {sentence} {sentence}", "a", None, None) for i in range(600)]
    cuts = [(1000 + i, f"Item {chr(97 + i)}. {sentence} The committee examined the revised propo", "a", None, None) for i in range(5)]
    # ends behind much white space, many marks, and a word of many letters, which is no beginning
    far = [(2000, f"{sentence} The committee examined the revised{' ' * 900}", "a", None, None), (2001, f"{sentence} The committee examined{'…' * 900} \n", "a", None, None), (2002, f"{sentence} {'x' * 20_000}", "a", None, None)]
    found = {x.doc_id for x in truncated(spark.createDataFrame(rows + cuts + far, DOCS)).where("is_cut").collect()}
    assert found == {*range(1000, 1005), 2000, 2001}


def test_misread_words_are_replaced():
    v = Vocabulary({"government": 900, "scheme": 800, "Scheme": 40, "were": 700, "present": 900, "pre": 2, "sent": 3, "released": 600, "funds": 600, "are": 800, "cent": 300, "paid": 60, "laid": 400, "officers": 500, "Officers": 900}, {})
    assert repaired("(govern~ment) Scherne fun|s relea5ed, scHeme гeleased pai•d xy~zw", v) == "(government) Scheme funds released, scheme released paid xy~zw"
    assert repaired("were pre sent. GOVERMMENT 0fficers", v) == "were present. GOVERNMENT Officers"
    assert repaired("the gov-\nernmemt funds", v) == "the government funds"
    noisy, clean = scan(3, 7), "government"
    assert "govern~ment" in noisy[0] and "~" not in repaired(noisy[0], Vocabulary({clean: 90, **dict.fromkeys(WORDS, 90)}, {}))
