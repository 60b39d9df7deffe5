"""Languages of documents and of the passages in them (problem 8).

Hyperdimensional profiles: every letter has a random vector of +1 and -1; a trigram is bound from the permuted vectors
of its letters; a text, or a language, is the bundle (sum) of its trigrams; texts are compared with language prototypes
by cosine. A bundle's product with a prototype is the sum of its trigrams' products, so these are tabulated once for all
trigrams of the folded alphabet, and a text is scored by looking its trigrams up, without building its bundle.

Prototypes are fitted on a bounded sample of labelled rows (``SAMPLE`` documents a language of at most ``SAMPLE_CHARS``
characters, the least by a hash of their id); documents that the first prototypes give to another language are left out
of the second fit, so wrong labels do little. Everything else covers every document whole.

A sentence is what ends in a full stop, question mark, exclamation mark, colon or semicolon before a gap, and has at least
``MIN_WORDS`` words; a sentence goes to the language of greatest cosine if that beats the document's main language
clearly, else to the main language. Letters are folded (case, accents, width), so capitals and missing accents do not matter.

Defined results: null, empty and blank texts and texts without letters have no languages; ties go to the language first
in the alphabet; repeated rows give repeated results; with no labelled row at all nothing is known and nothing is given.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.partitioning import bounded_broadcast, spread

SAMPLE = 300
SAMPLE_CHARS = 20_000
DIMENSIONS = 1024
SEED = 20_240_101
MIN_WORDS = 4
#: By how much, in standard deviations of a sentence's score, another language must beat a document's main language.
CLEAR = 3.0
#: Whole sentences that make a language one of the document's.
MIN_SENTENCES = 2
BLOCK = 400_000

LATIN, GREEK, CYRILLIC = "abcdefghijklmnopqrstuvwxyz", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщъьюя"
ALPHABET = LATIN + GREEK + CYRILLIC
SIZE = len(ALPHABET) + 2  # 0: gap, the last: any other letter
DROP = 255
_TERMINATORS, _CLOSERS, _OPENERS = ".!?:;…", "»”’\"')]*_", "«“„\"'([#*-"


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the folded symbol, and flags (1 white space, 2 line end, 4 terminator, 8 closer, 16 may begin a sentence, 32 opens a quotation)."""
    top = 0x20000
    symbol, flag = np.zeros(top, np.uint8), np.zeros(top, np.uint8)
    place = {c: i + 1 for i, c in enumerate(ALPHABET)} | {"ς": ALPHABET.index("σ") + 1}
    for code in range(top):
        if 0x3400 <= code < 0xA000 or 0xAC00 <= code < 0xD7A4 or 0xD800 <= code < 0xF900:
            symbol[code] = SIZE - 1 if code < 0xD800 else 0
            flag[code] = 16
            continue
        c = chr(code)
        kind = unicodedata.category(c)
        if kind in ("Mn", "Cf", "Cc") and not c.isspace():
            symbol[code] = DROP
        elif kind[0] == "L":
            if code < 0x2000 or code >= 0xFB00:
                base = unicodedata.normalize("NFKD", c).casefold()
                base = place.get(c.lower()) or place.get(unicodedata.normalize("NFKD", base)[:1]) or place.get({"ł": "l", "ø": "o", "đ": "d"}.get(base, ""))
                symbol[code] = base or SIZE - 1
            else:
                symbol[code] = SIZE - 1
            if c.isupper() or c.istitle() or not c.islower():
                flag[code] |= 16
        if c.isspace():
            flag[code] |= 1
        if c in "\n\r\v\f\x85  ":
            flag[code] |= 2
        if c in _TERMINATORS:
            flag[code] |= 4
        if c in _CLOSERS:
            flag[code] |= 8
        if c in _OPENERS or kind in ("So", "Cn", "Co"):
            flag[code] |= 16
        if c in "«“„":
            flag[code] |= 32
    return symbol, flag


_SYMBOL, _FLAG = _tables()


class Parsed:
    """Texts as one run of folded symbols, cut into sentences."""

    def __init__(self, texts: list[str]) -> None:
        glued = "\n".join([*texts, ""])
        code = np.frombuffer(glued.encode("utf-32-le", "replace"), np.uint32)
        code = np.minimum(code, 0x1FFFF)
        self.starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        flag = _FLAG[code]
        solid = np.flatnonzero(flag & 1 == 0)
        if not len(solid):
            self.n, self.symbols = 0, np.zeros(0, np.uint8)
            return
        # a sentence ends between two solid characters with a gap between them
        i, j = solid[:-1], solid[1:]
        gap = j - i > 1
        i, j = i[gap], j[gap]
        last = i.copy()  # the last character that is no closing mark
        for _ in range(3):
            last = np.where((flag[last] & 8 > 0) & (last > 0), last - 1, last)
        ended = flag[last] & 4 > 0
        lines = np.cumsum(flag & 2 > 0)
        broken = lines[j] > lines[i]
        cut = broken | (ended & (flag[j] & 16 > 0))
        first = np.unique(np.concatenate([[0], self.starts, j[cut]]))
        ends_whole = np.zeros(len(code) + 1, bool)
        ends_whole[j[cut]] = ended[cut]
        # texts end where the next begins; their last sentences end with their last solid character
        after = np.searchsorted(solid, np.append(self.starts[1:], len(code))) - 1
        tail = solid[np.maximum(after, 0)]
        for _ in range(3):
            tail = np.where((flag[tail] & 8 > 0) & (tail > 0), tail - 1, tail)
        ends_whole[np.append(self.starts[1:], len(code))] = flag[tail] & 4 > 0
        self.first = first
        self.doc = np.searchsorted(self.starts, first, "right") - 1
        self.n = len(first)
        self.end = np.append(first[1:], len(code))
        self.whole = ends_whole[self.end] & (flag[first] & 32 == 0)  # a phrase in quotation marks is no sentence
        symbol = _SYMBOL[code]
        of = np.zeros(len(code), np.int32)
        of[first[1:]] = 1
        of = np.cumsum(of, dtype=np.int32)
        kept = symbol != DROP
        symbol, of = symbol[kept], of[kept]
        new = np.ones(len(symbol), bool)
        new[1:] = (symbol[1:] != 0) | (symbol[:-1] != 0) | (of[1:] != of[:-1])
        self.symbols, self.of = symbol[new], of[new]
        start = np.zeros(len(self.symbols), bool)
        start[1:] = (self.symbols[1:] != 0) & (self.symbols[:-1] == 0)
        if len(start):
            start[0] = self.symbols[0] != 0
        self.words = np.bincount(self.of[start], minlength=self.n)

    def trigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all trigrams that lie in one sentence and hold a letter, and the sentences they are in."""
        s = self.symbols.astype(np.uint32)
        if len(s) < 3:
            return np.zeros(0, np.uint32), np.zeros(0, np.int32)
        number = (s[:-2] * SIZE + s[1:-1]) * SIZE + s[2:]
        inside = self.of[:-2] == self.of[2:]
        return number[inside], self.of[2:][inside]


def letter_vectors() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], np.float32), (SIZE, DIMENSIONS))


def bundle(counts: np.ndarray) -> np.ndarray:
    """The bundle of a text or language with these trigram counts (SIZE ** 3 of them)."""
    v = letter_vectors()
    one, two = np.roll(v, 1, axis=1), np.roll(v, 2, axis=1)
    cube = counts.reshape(SIZE, SIZE, SIZE).astype(np.float32)
    out = np.zeros(DIMENSIONS, np.float32)
    for a in range(SIZE):
        if cube[a].any():
            out += two[a] * (one * (cube[a] @ v)).sum(axis=0)
    return out


def products(prototypes: np.ndarray) -> np.ndarray:
    """The product of every trigram's vector with every prototype: SIZE ** 3 rows, a column a language."""
    v = letter_vectors()
    one, two = np.roll(v, 1, axis=1), np.roll(v, 2, axis=1)
    n = len(prototypes)
    right = (v[:, None, :] * prototypes[None, :, :]).reshape(SIZE * n, DIMENSIONS).T.copy()
    out = np.empty((SIZE, SIZE, SIZE * n), np.float16)
    for a in range(SIZE):
        out[a] = (two[a] * one) @ right
    return out.reshape(SIZE**3, n)


class Model:
    """Language prototypes, and the table of their products with all trigrams."""

    def __init__(self, languages: list[str], prototypes: np.ndarray) -> None:
        self.languages = languages
        centred = prototypes / np.linalg.norm(prototypes, axis=1, keepdims=True)
        centred = centred - centred.mean(axis=0)
        self.prototypes = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
        # unit prototypes have products of about 1 in size with any trigram, so that a sum over n varies by sqrt(n)
        self.table = products(self.prototypes)

    def scores(self, p: Parsed) -> tuple[np.ndarray, np.ndarray]:
        """By sentence and language the sum of the products, and by sentence the number of trigrams."""
        out = np.zeros((p.n, len(self.languages)), np.float32)
        number, of = p.trigrams()
        for k in range(0, len(number), BLOCK):
            part, where = number[k : k + BLOCK], of[k : k + BLOCK]
            begins = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
            sums = np.add.reduceat(self.table[part].astype(np.float32), begins, axis=0)
            np.add.at(out, where[begins], sums)
        return out, np.bincount(of, minlength=p.n)


def fit(texts: list[str], labels: list[str]) -> Model | None:
    """Prototypes of labelled texts, fitted twice: the second time without the texts that the first gave to another language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    index = {c: i for i, c in enumerate(languages)}
    truth = np.array([index[c] for c in labels])
    keep = np.ones(len(texts), bool)
    parsed = Parsed(texts)
    number, of = parsed.trigrams() if parsed.n else (np.zeros(0, np.uint32), np.zeros(0, np.int32))
    doc = parsed.doc[of] if parsed.n else of
    model = None
    for _ in range(2):
        protos = []
        for k in range(len(languages)):
            counts = np.bincount(number[(truth == k)[doc] & keep[doc]], minlength=SIZE**3) if len(number) else np.zeros(SIZE**3)
            protos.append(bundle(counts) + 1e-6)
        model = Model(languages, np.stack(protos))
        if parsed.n:
            sums, _ = model.scores(parsed)
            total = np.zeros((len(texts), len(languages)))
            np.add.at(total, parsed.doc, sums)
            keep = total.argmax(axis=1) == truth
    return model


def detect(model: Model, texts: list[str]) -> list[list[tuple[int, int, int, float, int]]]:
    """Of each text its passages: (language, begin, end, confidence, whole sentences), neighbours of one language joined."""
    p = Parsed(texts)
    found: list[list[tuple[int, int, int, float, int]]] = [[] for _ in texts]
    if not p.n:
        return found
    sums, grams = model.scores(p)
    total = np.zeros((len(texts), sums.shape[1]), np.float32)
    np.add.at(total, p.doc, sums)
    main = total.argmax(axis=1)[p.doc]
    best = sums.argmax(axis=1)
    rows = np.arange(p.n)
    spread_of = np.sqrt(np.maximum(grams, 1))
    other = sums[rows, best] - sums[rows, main] > CLEAR * spread_of
    whole = p.whole & (p.words >= MIN_WORDS)
    chosen = np.where(other, best, main)
    top = sums[rows, chosen]
    sums[rows, chosen] = -np.inf
    second = sums.max(axis=1) if sums.shape[1] > 1 else np.zeros(p.n)
    sure = 1 - np.exp(-np.maximum(top - second, 0) / (2 * spread_of))
    use = np.flatnonzero(grams > 0)
    lists = (p.doc[use].tolist(), chosen[use].tolist(), p.first[use].tolist(), p.end[use].tolist(), sure[use].tolist(), whole[use].tolist(), grams[use].tolist())
    begins = p.starts.tolist()
    run: list = []
    for d, k, b, e, s, w, g in zip(*lists, strict=True):
        if run and run[0] == d and run[1] == k:
            run[3] = e
            run[4] += s * g
            run[5] += int(w)
            run[6] += g
            continue
        if run:
            o = begins[run[0]]
            found[run[0]].append((run[1], run[2] - o, min(run[3] - o, len(texts[run[0]])), run[4] / run[6], run[5]))
        run = [d, k, b, e, s * g, int(w), g]
    if run:
        o = begins[run[0]]
        found[run[0]].append((run[1], run[2] - o, min(run[3] - o, len(texts[run[0]])), run[4] / run[6], run[5]))
    return found


def train(documents: DataFrame, lang_codes: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Fits prototypes on at most ``sample`` labelled documents a language."""
    codes = bounded_broadcast(lang_codes.groupBy(F.col("alias").alias("lang")).agg(F.min("code").alias("code")), 64)
    usable = documents.where(F.length("text").between(100, SAMPLE_CHARS))
    narrow = usable.select("doc_id", "lang").join(codes, "lang")
    by = Window.partitionBy("code").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = narrow.withColumn("r", F.row_number().over(by)).where(F.col("r") <= sample).select("doc_id", "code").distinct()
    rows = usable.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("code", "text").collect()
    rows = sorted(rows)
    return fit([r.text for r in rows], [r.code for r in rows])


def languages(documents: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang, passages) of every document; a passage is (lang, begin, end, confidence, sentences), places in code points."""
    ddl = "doc_id bigint, lang string, passages array<struct<lang:string,begin:int,end:int,confidence:double,sentences:int>>"
    df = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")
    if model is None:
        return df.where("false").select("doc_id", "lang", F.lit(None).cast(ddl.split("passages ")[1]).alias("passages"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # the size follows from the alphabet, not from the data
    names = model.languages
    fields = [("lang", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("confidence", pa.float64()), ("sentences", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            found: list = []
            k = 0
            while k < len(texts):
                size, n = 0, k
                while n < len(texts) and (n == k or size + len(texts[n]) <= 2 * BLOCK):
                    size += len(texts[n])
                    n += 1
                found += detect(known, texts[k:n])
                k = n
            flat = [x for f in found for x in f]
            cols = list(zip(*flat, strict=True)) if flat else [()] * 5
            cols[0] = [names[x] for x in cols[0]]
            values = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields, strict=True)], names=[f for f, _ in fields])
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            passages = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), passages], names=["doc_id", "lang", "passages"])

    return spread(df).mapInArrow(run, ddl)


def document_languages(found: DataFrame, lang_codes: DataFrame) -> DataFrame:
    """(doc_id, label, langs, main): the label's code, null if it names no language; the languages of at least two whole sentences; the main one.

    ``langs`` holds (lang, sentences, confidence), the language with most sentences first. ``main`` is the first of them or,
    where no language has two whole sentences, the one in which most of the text stands; null without any letters.
    """
    codes = bounded_broadcast(lang_codes.groupBy(F.col("alias").alias("lang")).agg(F.min("code").alias("label")), 64)
    df = found.join(codes, "lang", "left")
    each = F.transform(
        F.array_distinct(F.transform("passages", lambda p: p["lang"])),
        lambda c: F.aggregate(
            F.filter("passages", lambda p: p["lang"] == c),
            F.struct(F.lit(0).alias("sentences"), F.lit(0.0).cast("double").alias("w"), F.lit(0).alias("n"), c.alias("lang")),
            lambda a, p: F.struct((a["sentences"] + p["sentences"]).alias("sentences"), (a["w"] + p["confidence"] * (p["end"] - p["begin"])).alias("w"), (a["n"] + p["end"] - p["begin"]).alias("n"), a["lang"].alias("lang")),
        ),
    )
    kept = F.filter(each, lambda x: x["sentences"] >= MIN_SENTENCES)
    shown = lambda xs: F.transform(xs, lambda x: F.struct(x["lang"].alias("lang"), x["sentences"].alias("sentences"), (x["w"] / F.greatest(x["n"], F.lit(1))).alias("confidence")))
    longest = F.array_sort(F.transform(each, lambda x: F.struct((-x["n"]).alias("k"), x["lang"].alias("l"), x.alias("x"))))
    df = df.select("doc_id", "label", shown(F.reverse(F.array_sort(kept))).alias("langs"), shown(F.transform(F.slice(longest, 1, 1), lambda x: x["x"])).alias("longest"))
    return df.select("doc_id", "label", "langs", F.coalesce(F.get("langs", F.lit(0)), F.get("longest", F.lit(0))).alias("main"))


def relabelled(by_document: DataFrame) -> DataFrame:
    """(doc_id, lang) of every language of documents whose label is missing, unknown or wrong, or that mix languages."""
    has = F.exists("langs", lambda x: x["lang"] == F.col("label"))
    odd = F.col("label").isNull() | ~has | (F.size("langs") > 1)
    return by_document.where(odd).select("doc_id", F.explode("langs.lang").alias("lang")).distinct()
