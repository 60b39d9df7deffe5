"""Operators on texts against brute force, exact round trips and small made cases."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexweave.llm import bpe, budget, folding, language, leakage, lookalikes, markup, splitting

VOCABULARY = bpe.vocabulary()

# ------------------------------------------------------------------------------------------------------------- bpe

ODD = ["", " ", "  a", "a  b", "a\n b", "a\n\n  b\t", "it's  we'll I'D", "x " * 3, "日本語 текст ελληνικά", "é́", "😀👍🏽", "\u200b\xa0 \u3000", "1234567 ½ ²", "<|endoftext|>", "a" * 3000, "𐌰𐌱" * 400, "-" * 99, "a\r\n b", " lead", "trail ", "trail\n "]


@pytest.fixture(scope="module")
def reference():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def ids(text):
    return np.frombuffer(bpe.encoder(VOCABULARY).encode(text), np.int32).tolist()


@pytest.mark.parametrize("text", ODD)
def test_ids(reference, text):
    assert ids(text) == reference(text)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60) | st.text("ab '\n .1é", max_size=60))
def test_ids_of_any_text(reference, text):
    assert ids(text) == reference(text)


def test_queue_pops_least_rank_first():
    q, rng = bpe.RankQueue(), random.Random(1)
    want = {}
    for i in range(500):
        r = rng.randrange(50_000)
        q.push(r, i)
        want.setdefault(r, []).append(i)
    got = []
    while (x := q.pop()) is not None:
        got.append(x)
    assert got == sorted(want.items())


def test_encode_rows(spark):
    df = spark.createDataFrame([(1, "ab c", "x"), (2, None, "y"), (3, "", "z"), (1, "ab c", "x")], "doc_id bigint, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in bpe.encode(df, VOCABULARY).collect())
    assert got == [(1, ids("ab c")), (1, ids("ab c")), (2, []), (3, [])]
    assert bpe.encode(df.where("false"), VOCABULARY).count() == 0


def test_budget(spark):
    chunks = spark.createDataFrame(
        [("c1", "d1", "one two", 1), ("c1", "d1", "one two", 2), ("c2", "d1", "one two", 1), ("c3", "d2", "other", 1), ("c4", "d3", "one two", 1), ("c5", "d3", None, 1), ("c6", None, "x", 1)],
        "chunk_id string, doc_id string, text string, loaded_at int",
    ).withColumn("k", F.lit(0))
    meta = spark.createDataFrame([("d1", 1, "S", "English", {"domain": "food"}), ("d1", 2, "S", "German", {"domain": "food"}), ("d2", 1, " ", "??", None), ("d1", 2, "S", "German", {"domain": "food"})], "doc_id string, revision int, source string, language string, extra map<string,string>")
    codes = spark.createDataFrame([("en", "English"), ("de", "German")], "code string, alias string")
    two, other, x = len(ids("one two")), len(ids("other")), len(ids("x"))
    got = {(r.source, r.language, r.domain): (r.n_docs, r.n_chunks, r.n_texts, r.n_tokens) for r in budget.token_budget(chunks, meta, codes, VOCABULARY).collect()}
    assert got == {("S", "de", "food"): (1, 2, 1, 2 * two), (None, "und", None): (3, 4, 4, other + two + x)}
    assert budget.token_budget(chunks.where("false"), meta, codes, VOCABULARY).count() == 0


# ------------------------------------------------------------------------------------------------------- splitting


@settings(max_examples=80, deadline=None)
@given(st.text(st.sampled_from("ab .\n,;é\u0301\u200d\u2029 "), min_size=0, max_size=400), st.integers(5, 60), st.integers(0, 4))
def test_pieces_give_back_the_text(text, limit, overlap):
    pieces = splitting.split_text(text, limit, overlap)
    assert "".join(text[own:end] for _, own, end in pieces) == text
    for (b0, _, e0), (b1, o1, e1) in zip(pieces, pieces[1:], strict=False):
        assert o1 == e0 and b0 <= b1 <= o1 and o1 - b1 <= overlap + overlap // 2 and e1 - b1 <= limit
        assert b1 in (b0, o1) or not splitting._parted(text, b1) or all(splitting._parted(text, k) for k in range(b1, o1))
    assert all(e - b <= limit for b, _, e in pieces)
    for n, ((_, o0, _), (_, _, e1)) in enumerate(zip(pieces, pieces[1:], strict=False)):  # no two neighbours could be one
        assert e1 - o0 > (limit - overlap if n else limit)


def test_cuts_stand_at_strong_boundaries():
    text = "One two three. Four five six.\n\nSeven eight nine. Ten eleven twelve."
    assert [text[o:e] for _, o, e in splitting.split_text(text, 40, 0)] == [text[:31], text[31:]]
    assert splitting.cuts("x" * 25, 10, 2) == [8, 16, 24, 25]
    with pytest.raises(ValueError, match="overlap"):
        splitting.cuts("x", 5, 5)


def test_overlaps_begin_at_words_and_pieces_are_filled():
    text = "Ten words make up this one sentence of the text. " * 60
    pieces = splitting.split_text(text)
    assert all(text[b - 1] == " " and 60 <= o - b <= 180 for b, o, _ in pieces[1:]) and all(e - b > 1000 for b, _, e in pieces[:-1])
    marked = "e\u0301" * 900
    assert all(not splitting._parted(marked, b) for b, _, _ in splitting.split_text(marked)[1:])


def test_pieces_of_rows(spark):
    df = spark.createDataFrame([("chunk", "a", "w " * 700), ("chunk", "b", "short"), ("block", None, "w " * 700), ("chunk", "a", "w " * 700), ("chunk", "n", None)], "item_kind string, item_id string, text string").withColumn("piece", F.lit(1))
    out = splitting.pieces(df).distinct()
    assert sorted({(r.item_kind, r.item_id) for r in out.collect()}, key=str) == [("block", None), ("chunk", "a")]
    assert splitting.oversized(out).count() == 2 and splitting.pieces(df.where("false")).count() == 0


# ------------------------------------------------------------------------------------------------------ lookalikes


@pytest.mark.parametrize(
    ("a", "b"),
    [("\uff46\uff4f\uff52\u3000a", "for a"), ("\u0430 l\u043ead", "a load"), ("e\u0301", "é"), ("e\u200b\u0301", "é"), ("\ufb01ne", "fine"), ("a\u00a0b\u2009c", "a b c"), ("x\u00ady", "xy"), ("a\u2011b", "a-b"), ("\u03ac", "\u03b1\u0301"), ("\u0438\u0306", "\u0439"), ("a\r\nb", "a\nb"), ("\u0391\u0301", "Á")],
)
def test_same_look(a, b):
    assert lookalikes.canonical_text(a) == lookalikes.canonical_text(b)


@pytest.mark.parametrize(("a", "b"), [("a", "A"), ("e", "é"), ("1", "2"), ("½", "1/2"), ("²", "2"), ("a b", "ab"), ("o", "0")])
def test_different_look(a, b):
    assert lookalikes.canonical_text(a) != lookalikes.canonical_text(b)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=40))
def test_form_is_stable(text):
    once = lookalikes.canonical_text(text)
    assert lookalikes.canonical_text(once) == once


def test_every_character_is_stable():
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            once = lookalikes.canonical_text(f"a{chr(code)}b")
            assert lookalikes.canonical_text(once) == once, hex(code)


def test_composed_and_decomposed_letters_are_one():
    import unicodedata

    for code in range(0x30000):
        apart = unicodedata.normalize("NFD", chr(code)) if not 0xD800 <= code < 0xE000 else chr(code)
        if apart != chr(code):
            assert lookalikes.canonical_text(apart) == lookalikes.canonical_text(chr(code)), hex(code)


@pytest.mark.parametrize("c", ["\ufe0f", "\u034f", "\u180b", "\u200d", "\u2060", "\ufeff", "\U000e0041", "\U000e0100", "\u061c" * 0])
def test_invisible_characters_vanish(c):
    assert lookalikes.canonical_text(f"a{c}e{c}\u0301{c}") == "a\u00e9"


def test_further_look_alikes():
    assert lookalikes.canonical_text("\u2163 \u217b") == "IV xii" and lookalikes.canonical_text("\u13a0\u0555\u3164x\u00b5") == "DO x\u03bc"
    assert lookalikes.canonical_text("\uff76\uff9e") == "\u30ac" and lookalikes.canonical_text("\u1112\u1161\u11ab") == "\ud55c"
    more = lookalikes.confusables(["# remark", "0431 ; 0036 ; MA # be", "0021 0021 ; 203C", ""])
    assert more == {"\u0431": "6", "!!": "\u203c"}
    assert lookalikes.Transducer(lookalikes.rules() | lookalikes.LINE_ENDS | more)("\u0431!!\u0430") == "6\u203ca"


def test_conflicts_are_found():
    with pytest.raises(lookalikes.Conflict):
        lookalikes.Transducer({"a": "b", "b": "a"})
    with pytest.raises(lookalikes.Conflict):
        lookalikes.Transducer({"ab": "c", "c": "d"})


def test_pairs_match_brute_force(spark):
    rng = random.Random(5)
    texts = ["the load", "the l\u043ead", "the\u00a0load", "The load", "fine", "\ufb01ne", "fine", "é", "e\u0301", None, ""]
    rows = [(rng.choice(["chunk", "block"]), f"i{n:03}", rng.choice(texts)) for n in range(150)]
    rows += rows[:20] + [("chunk", None, "the load")]
    df = spark.createDataFrame(rows, "item_kind string, item_id string, text string").withColumn("form", F.lit("x"))
    own = [r for r in dict.fromkeys(rows) if r[1] and r[2] is not None]
    want = {(k, a, b) for k, a, x in own for k2, b, y in own if k == k2 and a < b and x != y and lookalikes.canonical_text(x) == lookalikes.canonical_text(y)}
    got = [tuple(r) for r in lookalikes.same_look(df, hot=3).collect()]
    assert set(got) == want and len(got) == len(want) and lookalikes.same_look(df.where("false")).count() == 0
    classes = {}
    for r in lookalikes.look_classes(df).collect():
        classes.setdefault((r.item_kind, r["class"]), set()).add(r.item_id)
    linked = {(k, a, b) for (k, _), ids in classes.items() for a in ids for b in ids if a < b}
    assert linked >= want and {x for k, a, b in want for x in ((k, a), (k, b))} == {(k, i) for (k, _), ids in classes.items() for i in ids}


# ---------------------------------------------------------------------------------------------------------- markup

CLEAN = ["- (a) plain", "x (\\*) y (*) z", "5 * 3 * 2 cells", "value < 62 and > 84", "at $ 5 to $ 7 million", "[12] [sic] [3](b)", "{a, b}", "see file a_b_c.csv", "R&D; AT&T", "l'acte d'un", "a|b", "", "#61 item", "a**2 and b**3", "2 ^ 3", "**", "||", "if x <b and c> d", "_config_.yml", "text <name> here", "[12][13]", "C:\\temp\\x", "* note", "a <b", "x\n-- y"]
MARKED = {
    "<p>a</p>": "a", "a<br />b": "a\nb", "a &amp; b": "a & b", "**bold** x": "bold x", "__bold__": "bold", "*it* x": "it x", "~~no~~": "no", "`code`": "code", "[la](/doc/x-1)": "la",
    "a\n\n## Head\n\nb": "a\n\nHead\n\nb", "== Head ==": "Head", "[[Page|label]]": "label", "a {{t|5|y=1}}": "a  5", "''it''": "it", "\\textbf{b} c": "b c", "{\\em b} c": "b c",
    "$x_{2} \\le 5$": "x_2 ≤ 5", "\\(k^{5}\\)": "k^5", "\\[ R = \\frac{n_2}{46 + N} \\]": "R = (n_2)/(46 + N)", "\\section{T}": "T", "|a|b|\n|---|---|\n|1|2|": "a | b\n1 | 2",
    "<ul><li>a</li>\n<li>b</li></ul>": "- a\n\n- b", "\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}": "- a\n- b", "```\nx = 1\n```": "x = 1", "<!-- c -->a": "a", "a\n> b": "a\nb", "a~\\cite{b}": "a",
    "&amp;lt;b&amp;gt;": "&lt;b&gt;", "&lt;p&gt; stays": "<p> stays", "<code>x &lt; <b>*y*</b></code>": "x < *y*", "`a *b* <i>`": "a *b* <i>", "<![CDATA[a <b> c]]>": "a <b> c", "~~~\na *b*\n~~~": "a *b*",
    '<a title="x > y">z</a>': "z", "<address>x</address>": "x", "<video controls>x</video>": "x", "<w:p>a</w:p>": "a", "<foo>x</foo>": "x", "<!DOCTYPE html>\n<p>a": "a", "<http://a.b/c>": "http://a.b/c",
    "Head\n====\ntext": "Head\n\ntext", "* a\n* b": "- a\n- b", "[t][1]\n\n[1]: http://x.y/z": "t", "a[^1]\n\n[^1]: note": "a\n\n(note)", "[http://x.y label]": "label", "{{t\n|a\n|b}}": "a\n b",
    "\\textbf{a {b} c}": "a {b} c", "\\LaTeX": "LaTeX", "a<ref>note</ref>": "a (note)", "\\footnote{a {b}}": "(a {b})", "\\begin{verbatim}\n*x*\n\\end{verbatim}": "*x*",
}


@pytest.mark.parametrize("text", CLEAN)
def test_ordinary_signs_are_kept(text):
    assert markup.convert(text) == (text, [], [])


@pytest.mark.parametrize(("text", "clean"), MARKED.items())
def test_markup_is_converted(spark, text, clean):
    got, _, applied = markup.convert(text)
    assert applied and got == clean


def test_marks_and_rows(spark):
    clean, marks, _ = markup.convert("# H\n`c` $a_1$\n|x|y|\n|---|---|\n")
    assert [(k, clean[b:e]) for k, b, e in marks] == [("heading", "H"), ("code", "c"), ("formula", "a_1"), ("table", "x | y")]
    rows = [("chunk", str(i), t) for i, t in enumerate([*CLEAN, *MARKED, None])]
    df = spark.createDataFrame(rows, "item_kind string, item_id string, text string")
    got = {r.item_id for r in markup.converted(df).collect()}
    assert got == {str(i) for i in range(len(CLEAN), len(CLEAN) + len(MARKED))} and markup.converted(df.where("false")).count() == 0


@pytest.mark.parametrize("depth", [7, 12, 40])
def test_deeply_nested_markup_leaves_no_residue(depth):
    nested = {r"\textbf{": "}", "{{x|": "}}", r"\emph{\textit{": "}}"}
    for begin, end in nested.items():
        assert markup.convert(f"{begin * depth}word{end * depth}")[0].strip() == "word"
    assert markup.formula(r"\sqrt{" * depth + "x" + "}" * depth) == "√(" * depth + "x" + ")" * depth


# --------------------------------------------------------------------------------------------------------- leakage

WORDS = [f"w{i}{c}" for i in range(400) for c in "abc"]
FORMULA = "this act takes effect on the tenth day after it is entered in the common book of rules"


def make_items(n=30):
    rng = random.Random(3)
    out = {}
    for i in range(n):
        words = rng.sample(WORDS, 44)
        out[i] = " ".join(words[:20]) + ". " + (FORMULA + ". " if i % 3 == 0 else "") + " ".join(words[20:])
    return out


def test_leaks(spark):
    items, rng = make_items(), random.Random(4)
    filler = lambda n: " ".join(rng.choice(["the", "board", "shall", "file", "of", "notice"]) for _ in range(n))
    docs, want = [], set()
    for i, text in items.items():
        w = text.replace(FORMULA + ". ", "").split()
        kinds = [
            (filler(30) + " " + text + " " + filler(20), True), (" ".join(w[:30]).upper(), True), (" ".join(w[:17]) + " " + filler(25) + "\n" + " ".join(w[-14:]), True),
            (" ".join(x if k % 6 else x[:-1] + "z" for k, x in enumerate(w)), True), (filler(10) + " " + " ".join(w[:19]) + " " + filler(10), False), (FORMULA + " " + filler(40), False), (filler(80), False),
            ("\u200b".join(text.replace("a", "\u0430")), True),
        ]
        for k, (doc, leaks) in enumerate(kinds):
            docs.append((i * 10 + k, doc))
            if leaks:
                want.add((i * 10 + k, i))
    docs += [(9000, None), (9001, ""), (9002, " \n")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item_id", F.lit("x"))
    e = spark.createDataFrame([*items.items(), (900, None), (901, " "), (902, FORMULA)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in leakage.leaks(d, e).collect()}
    assert got == want, (got - want, want - got)
    assert leakage.leaks(d, e.where("false")).count() == 0 and leakage.leaks(d.where("false"), e).count() == 0


def test_leaks_of_short_items_and_documents():
    texts = ["kelvar tromino", "dastrel vokun mirabel", "quintar zophel brimald yestern", "ulmarit pesgol wendra hactil oskeran jubilor", "zorbane"]
    items = leakage.Items(list(range(len(texts))), texts)
    docs = [f"the report of the year says {t} and then goes on about other things" for t in texts] + ["quintar zophel brimold yestern", "zorbane", "nothing here"]
    want = {(k, k) for k in range(len(texts))} | {(5, 2), (6, 4)}
    for size in (1, 3, len(docs)):  # whatever else is in the batch
        got = {(k + d, i) for k in range(0, len(docs), size) for d, i, *_ in leakage.find(items, docs[k : k + size])}
        assert got == want
    long = leakage.Items([1, 2], ["kelvar tromino", " ".join(f"word{chr(97 + i)}{chr(98 + i)}" for i in range(20))])
    assert {x[:2] for x in leakage.find(long, docs)} == {(0, 0)}
    assert not leakage.find(leakage.Items([1], [" . "]), docs) and not leakage.find(items, ["", " "])


def test_leaks_do_not_depend_on_item_blocks(spark):
    items, rng = make_items(12), random.Random(8)
    items |= {100 + i: FORMULA + f" {w} " + " ".join(rng.sample(WORDS, 10)) for i, w in enumerate(("one", "two", "three"))}
    docs = [(i, " ".join(x for x in t.replace(FORMULA, "").split())) for i, t in items.items()] + [(900, FORMULA)]
    d, e = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    whole = sorted(tuple(r) for r in leakage.leaks(d, e).collect())
    assert {r[:2] for r in whole} == {(i, i) for i in items} and all(r[2] == 1.0 for r in whole)
    assert sorted(tuple(r) for r in leakage.leaks(d, e, block_chars=1200).collect()) == whole


def test_formula_runs_are_counted_alike(spark):
    items = make_items(9)
    df = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {r.item_id: r.starts for r in leakage.own_parts(df).collect()}
    words = folding.Words(list(items.values()))
    want = leakage.formula_starts([words.hash[words.doc == k] for k in range(len(items))])
    assert got == dict(zip(items, want, strict=True)) and sum(map(len, want)) == 3 * (len(FORMULA.split()) - 9)


def test_tiles_give_the_alignment_of_the_whole(monkeypatch):
    items, rng = make_items(6), random.Random(9)
    index = leakage.Items(list(items), list(items.values()))
    doc = " ".join(" ".join(t.split()[a : a + 30]) + " " + " ".join(rng.sample(WORDS, 90)) for t in items.values() for a in (0, 14) for _ in range(3))
    whole = leakage.find(index, [doc])
    monkeypatch.setattr(leakage, "TILE", 8)
    assert leakage.find(index, [doc]) == whole and {x[1] for x in whole} == set(range(6))


@pytest.mark.parametrize(("part", "noise"), [(0.62, 0.0), (0.62, 0.2), (0.7, 0.35), (1.0, 0.35)])
def test_recall_of_noisy_copies(part, noise):
    rng = random.Random(10)
    items = {i: " ".join(rng.choice("bcdfgklmnprst") + "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) for _ in range(rng.randint(50, 90))) for i in range(60)}
    index = leakage.Items(list(items), list(items.values()))

    def copy(text):
        w = text.split()
        n = int(np.ceil(part * len(w)))
        a = rng.randint(0, len(w) - n)
        w = [x[:k] + "q" + x[k + 1 :] if rng.random() < noise and (k := rng.randrange(len(x))) >= 0 else x for x in w[a : a + n]]
        return " ".join(["filler words of no import"] * 8 + w + ["and so on and on"] * 8)

    found = {x[:2] for x in leakage.find(index, [copy(t) for t in items.values()])}
    assert found <= {(i, i) for i in items} and len(found) >= 0.9 * len(items)


def test_equal_windows_have_equal_keys_and_near_ones_often_share_one():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 1 << 62, (500, leakage.WINDOW)).astype(np.uint64)
    b = a.copy()
    b[np.arange(500), rng.integers(0, leakage.WINDOW, 500)] = 5
    c = rng.integers(1, 1 << 62, (500, leakage.WINDOW)).astype(np.uint64)
    ka, kb, kc = leakage.keys_of(a), leakage.keys_of(b), leakage.keys_of(c)
    assert (ka == leakage.keys_of(a)).all() and not (ka == kc).any()
    assert (ka == kb).any(axis=1).mean() > 0.3


def test_words_fold():
    words = folding.Words(["Stra\u00dfe STRASSE \uff46or \u0430b\u200bc", "", "x"])
    assert [words.word(i) for i in range(5)] == ["strasse", "strasse", "for", "abc", "x"] and words.hash[0] == words.hash[1]


# -------------------------------------------------------------------------------------------------------- language

SPEECH = {
    "en": "The board shall examine the file within thirty days. Every manufacturer must keep the record of incidents. The panel may request a copy of the notice where safety so requires.",
    "de": "Der Ausschuss muss die Akte binnen dreißig Tagen prüfen. Jeder Hersteller hat das Verzeichnis der Vorfälle aufzubewahren. Die Kammer kann eine Abschrift der Meldung verlangen.",
    "el": "Η επιτροπή εξετάζει τον φάκελο εντός τριάντα ημερών. Κάθε κατασκευαστής πρέπει να τηρεί το μητρώο συμβάντων. Το γραφείο μπορεί να ζητήσει αντίγραφο της γνωστοποίησης.",
}


def test_languages(spark):
    rows = [(i * 10 + k, SPEECH[c] + f" {k}", c.upper() if k % 2 else c) for i, c in enumerate(SPEECH) for k in range(6)]
    odd = [(100, SPEECH["en"], "de"), (101, SPEECH["en"] + "\n\n" + SPEECH["de"], "en"), (102, SPEECH["el"].upper(), None), (103, SPEECH["en"] + " «Der Ausschuss».", "en"), (104, None, "en"), (105, "", None), (106, " \n", "xx"), (107, "12 34.", "en"), (108, SPEECH["de"], "??"), (108, SPEECH["de"], "??")]
    docs = spark.createDataFrame(rows + odd, "doc_id bigint, text string, lang string").withColumn("passages", F.lit(1))
    codes = spark.createDataFrame([(c, a) for c in SPEECH for a in (c, c.upper())], "code string, alias string")
    model = language.train(docs, codes)
    got = {(r.doc_id, r.lang) for r in language.relabelled(language.document_languages(language.languages(docs, model), codes)).collect()}
    assert got == {(100, "en"), (101, "en"), (101, "de"), (102, "el"), (108, "de")}
    short = docs.where("doc_id = 102").select("doc_id", F.lit("The board shall").alias("text"), "lang")
    one = language.document_languages(language.languages(short.unionByName(docs.where("doc_id = 107").select("doc_id", "text", "lang")), model), codes).collect()
    assert {(r.doc_id, r.langs == [], r.main and r.main.lang) for r in one} == {(102, True, "en"), (107, True, None)}
    p = language.languages(docs.where("doc_id = 101"), model).first().passages
    assert [(x.lang, x.sentences) for x in p] == [("en", 3), ("de", 3)] and p[0].begin == 0 and p[0].end == p[1].begin and all(0 <= x.confidence <= 1 for x in p)
    assert language.languages(docs.where("false"), model).count() == 0 and language.train(docs.where("false"), codes) is None
    assert language.languages(docs, None).count() == 0


def test_products_are_those_of_bundles():
    counts = np.zeros(language.SIZE**3)
    counts[[5, 700, 700, 90_000]] += 1
    counts[700] = 2
    v = language.bundle(counts)
    proto = np.random.default_rng(1).normal(size=(2, language.DIMENSIONS)).astype(np.float32)
    proto /= np.linalg.norm(proto, axis=1, keepdims=True)
    assert np.allclose(proto @ v, counts @ language.products(proto).astype(np.float64), atol=0.05)
