"""Operator 5, language identification by multilingual mixture inference.

Learning counts letter trigrams (with word borders) per language over all
training documents, aggregated in Spark. A document is a mixture of the
learned languages: each of its words comes from one of them, with the
likelihood of its trigrams. Expectation-maximisation estimates the document's
language proportions; its languages by falling proportion form nested sets, all
of them (one language up to every learned one) are compared by penalised
likelihood (BIC), and the chosen set is estimated once more. The prediction is
the language with the largest proportion, which is the score; ``known`` is the
share of the document's words of which some language knows a trigram.

Every count of every language is used. The counts stay in the table they are
written to; the driver holds a name and a total per language. Documents are
gathered into blocks, a block asks for its own distinct trigrams, and groups
of trigrams answer with their counts, packed. What a task holds at once is a
block with its answers and the likelihoods (distinct words x languages) of a
run of its documents, of one document at least.

Defined cases: null text, or text without a letter, gives ``und`` with score
0; without any training document every text does; ties go to the smaller
language name; null languages teach nothing; repeated rows are independent; an
empty table gives an empty result; columns of the input pass through untouched.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamart.llm.blocks import chunks, gather, packed, ranges, rest_columns, text_values, unpacked
from mediamart.llm.common import id_remainder, ship, slices, text_bytes, unused, written

FOLDS, HELD_OUT_FOLD = 4, 2
SMOOTHING = 0.5
ROUNDS, REFIT_ROUNDS, SETTLED = 12, 4, 1e-7
WORDS_HELD = 32 << 20        # bytes of words that are counted together
SCORED_BYTES, FOLDED_AT_ONCE = 4 << 20, 1 << 18
BLOCK_BYTES, BLOCK_LEVEL = 12 << 20, 5           # blocks are written and shuffled once: zstd level for less disk
GROUP_COUNTS, GROUP_ASKED, LEAST_GROUPS = 500_000, 2_000_000, 9
CELLS, CELLS_AT_ONCE = 8 << 20, 1 << 19       # words x languages of a run, and pairs x languages of a step
UNKNOWN, BORDER = "und", 2
SPECIAL = "\u0130", "\u03a3"         # lower case of the first is two characters, that of the second depends on its place
WORD = re.compile(r"[^\W\d_]+")
RESULT = "struct<lang:string,score:double,known:double>"


@lru_cache
def _folded(bits: int) -> np.ndarray:
    """Each code point below ``1 << bits`` in lower case, or BORDER if that is
    part of no word; SPECIAL ones are lowered before."""
    lower = "".join(map(chr, range(min(1 << bits, 0x110000)))).replace(SPECIAL[0], SPECIAL[0].lower()[0]).lower()
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full(len(codes), BORDER, np.uint32)
    for m in WORD.finditer(lower):
        out[m.start():m.end()] = codes[m.start():m.end()]
    return out


@lru_cache
def _kinds(bits: int) -> np.ndarray:
    """Of each code point: 1 if it is alphabetic, plus 2 if it is not numeric."""
    return np.array([c.isalpha() + 2 * (not c.isnumeric()) for c in map(chr, range(min(1 << bits, 0x110000)))], np.uint8)


def _bits(codes: np.ndarray) -> int:
    return int(codes.max()).bit_length()


def words_of(values: list[bytes]) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """How many words each text has, and the words of all texts in their order,
    in lower case, as code points of four bytes."""
    count, size, letters = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for a, b in chunks([len(v) for v in values]):
        texts = [v.decode() for v in values[a:b]]
        texts = [t.lower() if any(c in t for c in SPECIAL) else t for t in texts]
        raw = np.frombuffer("\n".join(["", *texts, ""]).encode("utf-32-le"), np.uint32)
        folded, codes = _folded(_bits(raw)), np.empty_like(raw)
        for i in range(0, len(raw), FOLDED_AT_ONCE):
            codes[i:i + FOLDED_AT_ONCE] = folded[raw[i:i + FOLDED_AT_ONCE]]
        letter = codes != BORDER
        edge = np.flatnonzero(letter[1:] != letter[:-1])     # before the first and at the last letter of each word
        count.append(np.diff(np.searchsorted(edge[::2], np.cumsum([len(t) + 1 for t in texts])), prepend=0))
        size.append(edge[1::2] - edge[::2])
        letters.append(codes[letter])
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *size])) * 4
    return np.concatenate(count), pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(letters))])


def distinct(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of each word, by first appearance; the sizes of the distinct
    words in that order, and their letters one after the other."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    coded = words.dictionary_encode()
    _, ends, letters = coded.dictionary.buffers()
    ends = np.frombuffer(ends, np.int64, len(coded.dictionary) + 1)
    return np.asarray(coded.indices).astype(np.int64), np.diff(ends) // 4, np.frombuffer(letters, np.uint32, int(ends[-1]) // 4)


def keys_of(size: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Key of every trigram of every word, with a border mark on both sides: a
    word has as many as letters. A key holds three code points."""
    place = np.arange(len(letters)) + np.repeat(np.arange(1, len(size) + 1), size)
    codes = np.full(len(letters) + len(size) + 1, BORDER, np.int64)
    codes[place] = letters
    key = codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:]
    return key[place - 1]             # a trigram whose middle is a border belongs to no word


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the trigrams of plain words, and the number of the word each is from."""
    size = np.array([len(w) for w in words], np.int64)
    return keys_of(size, np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)), np.repeat(np.arange(len(words)), size)


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all rows of (lang, text)."""
    ship(docs.sparkSession)

    def run(batches):
        held, size = {}, 0

        def flush():
            for lang, parts in held.items():
                word, long, letters = distinct(pa.concat_arrays(parts))
                gram, at = np.unique(keys_of(long, letters), return_inverse=True)
                n = np.bincount(at, weights=np.repeat(np.bincount(word), long)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()),
                                                  "gram": pa.array(gram), "n": pa.array(n)})

        for batch in batches:
            for part in slices(batch, 1):
                by = {}
                for lang, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1))):
                    by.setdefault(lang, []).append(text)
                for lang, values in by.items():
                    words = words_of(values)[1]
                    if len(words):
                        held.setdefault(lang, []).append(words)
                        size += words.nbytes
                if size > WORDS_HELD:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """``mass[l]``: trigrams of langs[l] in training; ``distinct`` trigrams of
    all; ``counts``: the written table of (lang, gram, n)."""

    def __init__(self, langs: list[str], mass: np.ndarray, distinct: int, counts: DataFrame | None):
        self.langs, self.counts = langs, counts
        self.unknown = np.log(SMOOTHING / (mass + SMOOTHING * (distinct + 1)))


class Counts:
    """Counts of some trigrams: of ``grams[i]``, entries ``start[i]`` up to
    ``start[i + 1]`` are the languages that have it and how often."""

    def __init__(self, gram: np.ndarray, lang: np.ndarray, n: np.ndarray):
        order = np.argsort(gram, kind="stable")
        gram, self.lang, self.n = gram[order], lang[order], n[order]
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
        self.grams, self.start = gram[first], np.r_[first, len(gram)]

    def entries(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``key``, entry) of all entries of the trigrams in ``key``."""
        if not len(self.grams):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.grams, key), len(self.grams) - 1)
        size = np.where(self.grams[at] == key, self.start[at + 1] - self.start[at], 0)
        place = np.repeat(np.arange(len(key)), size)
        return place, np.arange(len(place)) + np.repeat(self.start[at] - np.cumsum(size) + size, size)

    def words(self, size: np.ndarray, letters: np.ndarray, unknown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood of each word (``size`` of the letters each) in each
        language, and whether one of its trigrams has a count; ``unknown[l]``
        is the likelihood of a trigram without one."""
        out, met = size[:, None] * unknown, np.zeros(len(size), bool)
        more = np.log1p(self.n / SMOOTHING)      # what a count adds to ``unknown``
        ends, step = np.cumsum(size), max(1, CELLS_AT_ONCE // len(unknown))
        for a in range(0, len(size), step):
            some, part = size[a:a + step], out[a:a + step]
            place, entry = self.entries(keys_of(some, letters[ends[a] - size[a]:ends[a + len(some) - 1]]))
            owner = np.repeat(np.arange(len(some)), some)[place]
            met[a + owner] = True
            part += np.bincount(owner * len(unknown) + self.lang[entry], weights=more[entry], minlength=part.size).reshape(part.shape)
        return out, met


def fit(docs: DataFrame) -> Model:
    """Learn from the rows outside the held-out fold that have text and lang."""
    train = docs.where((id_remainder("doc_id", FOLDS) != HELD_OUT_FOLD) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = written(count_grams(train), "language_grams")
    total = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}   # a row per language
    langs = sorted(total)
    if not langs:
        return Model([], np.zeros(0), 0, None)
    return Model(langs, np.array([total[x] for x in langs], float), counts.select("gram").distinct().count(), counts)


def mixtures(ll: np.ndarray, doc: np.ndarray, n: np.ndarray, docs: int, word: np.ndarray | None = None) -> np.ndarray:
    """Proportions (docs x languages) by expectation-maximisation over the
    rows (doc, word, count), which are sorted by doc; ``ll[word]`` are a row's
    likelihoods (without ``word``: ll has a row for each). Languages outside
    the set chosen by penalised likelihood have proportion 0."""
    word = np.arange(len(doc)) if word is None else word
    like = ll - ll.max(1, keepdims=True)
    like = np.ascontiguousarray(np.exp(like, out=like).T)
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    size = np.diff(np.r_[first, len(doc)])
    out = np.zeros((docs, ll.shape[1]))
    for a, b in chunks((size * ll.shape[1]).tolist(), CELLS_AT_ONCE):
        rows = slice(first[a], first[a] + size[a:b].sum())
        out[doc[first[a:b]]] = _mixed(np.take(like, word[rows], 1), n[rows], size[a:b]).T
    return out


def _mixed(like: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Proportions (languages x documents) of a few documents, the likelihoods
    (languages x rows) and counts of whose ``size`` rows follow each other."""
    langs, first = len(like), np.cumsum(size) - size
    total = np.add.reduceat(n, first)

    def rounds(pi: np.ndarray, times: int, open_: np.ndarray) -> np.ndarray:
        """``times`` rounds for the documents of ``open_``, each until no
        proportion of it moves by more than SETTLED."""
        pi, at, own, count, rows = pi.copy(), np.arange(len(size)), like, n, size
        for _ in range(times):
            if not open_.all():
                keep = np.repeat(open_, rows)
                at, own, count, rows = at[open_], np.compress(keep, own, 1), count[keep], rows[open_]
            if not len(at):
                break
            was, cut, share = pi[:, at], np.cumsum(rows) - rows, np.zeros(len(count))
            held = np.flatnonzero(was.any(1))
            for j in held:
                share += own[j] * np.repeat(was[j], rows)
            share = count / np.maximum(share, 1e-300)
            new = np.zeros_like(was)
            for j in held:
                # without a share there may be no finite sum
                new[j] = np.where(was[j] > 0, np.add.reduceat(own[j] * share, cut), 0) * was[j] / total[at]
            pi[:, at] = new
            open_ = np.abs(new - was).max(0) > SETTLED
        return pi

    pi = rounds(np.full((langs, len(size)), 1.0 / langs), ROUNDS, np.ones(len(size), bool))
    order = np.argsort(-pi, axis=0, kind="stable")
    rank = np.argsort(order, axis=0, kind="stable")
    # the fit of each document's first 1, 2, ... languages: running sums by rank
    falling = np.take_along_axis(pi, order, 0)
    norm = np.log(np.maximum(np.cumsum(falling, 0), 1e-300))
    cost, held, row = np.empty_like(pi), np.zeros(len(n)), np.arange(len(n))
    for k in range(langs):
        held += like[np.repeat(order[k], size), row] * np.repeat(falling[k], size)
        cost[k] = k * np.log(total) - 2 * np.add.reduceat((np.log(np.maximum(held, 1e-300)) - np.repeat(norm[k], size)) * n, first)
    chosen = np.argmax(cost <= cost.min(0) + 1e-9, axis=0) + 1       # the smaller set of equals
    part = np.where(rank < chosen, pi, 0)
    # a set of one language is settled already
    return rounds(part / part.sum(0), REFIT_ROUNDS, chosen > 1)


def identify(values: list[bytes], langs: list[str], unknown: np.ndarray, counts: Counts) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and share of known words of each text."""
    lang, score, known = [UNKNOWN] * len(values), np.zeros(len(values)), np.zeros(len(values))
    count, words = words_of(values)
    ends = np.cumsum(count)
    for a, b in chunks((count * len(langs)).tolist(), CELLS):
        word, size, letters = distinct(words[ends[a] - count[a]:ends[b - 1]])
        if not len(word):
            continue
        pair, n = np.unique(np.repeat(np.arange(b - a), count[a:b]) * len(size) + word, return_counts=True)
        doc, word = np.divmod(pair, len(size))
        kinds = np.bitwise_or.reduceat(_kinds(_bits(letters))[letters], np.cumsum(size) - size)
        lettered = np.flatnonzero(np.bincount(doc, kinds[word] == 3, b - a))
        likelihood, met = counts.words(size, letters, unknown)
        pi = mixtures(likelihood, doc, n.astype(float), b - a, word)
        top = pi.argmax(1)
        for i in lettered:
            lang[a + i] = langs[top[i]]
        score[a + lettered] = np.minimum(pi[lettered, top[lettered]], 1.0)
        known[a + lettered] = (np.bincount(doc, n * met[word], b - a) / np.maximum(count[a:b], 1))[lettered]
    return lang, score, known


# -- what a block asks and is answered ----------------------------------------
_ASKED = pa.schema([("block", pa.int64()), ("asked", pa.int64()), ("keys", pa.binary())])
_PART = pa.schema([("block", pa.int64()), ("grp", pa.int64()), ("keys", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("gram", pa.binary()), ("lang", pa.binary()), ("n", pa.binary())])


def _ask(batches):
    """The distinct trigrams of each block, ascending."""
    for batch in batches:
        for row in batch.to_pylist():
            held, values = np.zeros(0, np.int64), text_values(row)
            for a, b in chunks(row["size"]):
                held = np.union1d(held, keys_of(*distinct(words_of(values[a:b])[1])[1:]))
            yield pa.RecordBatch.from_pylist([{"block": row["block"], "asked": len(held), "keys": packed(np.diff(held, prepend=0))}], _ASKED)


def _dealt(groups: int):
    """A row for each group that a block asks something of."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                key = np.cumsum(unpacked(row["keys"]))
                order = np.argsort(key % groups, kind="stable")
                key = key[order]
                for g, a, b in ranges(key % groups):
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "grp": g, "keys": packed(np.diff(key[a:b], prepend=0))}], _PART)
    return run


def _answer(langs: list[str]):
    """To each block the counts of the trigrams it asked for."""
    def run(known: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not known.num_rows:
            return _ANSWER.empty_table()
        place = {lang: j for j, lang in enumerate(langs)}
        names = known.column("lang").combine_chunks().dictionary_encode()
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        lang = np.array([place[x] for x in names.dictionary.to_pylist()], np.int64)[np.asarray(names.indices)]
        counts = Counts(np.asarray(known.column("gram")), lang, np.asarray(known.column("n")))
        out = []
        for block, keys in zip(asked.column("block").to_pylist(), asked.column("keys").to_pylist()):
            key = np.cumsum(unpacked(keys))
            at, entry = counts.entries(key)
            out.append({"block": block, "gram": packed(np.diff(key[at], prepend=0)), "lang": packed(counts.lang[entry], np.int32),
                        "n": packed(counts.n[entry])})
        return pa.Table.from_pylist(out, _ANSWER)
    return run


def predict(docs: DataFrame, model: Model, column: str, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column: struct(lang, score, known)."""
    if not model.langs:
        return docs.withColumn(column, F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("known")))
    spark = docs.sparkSession
    ship(spark)
    langs, unknown = model.langs, model.unknown
    no_text, at = unused(docs, "no_text"), docs.columns.index(text_col)
    blocks = written(gather(docs.withColumn(no_text, F.col(f"`{text_col}`").isNull()), text_col,
                            block_bytes=BLOCK_BYTES, level=BLOCK_LEVEL), "language_blocks")
    asked = written(blocks.select("block", "size", "texts").mapInArrow(_ask, "block long, asked long, keys binary"), "language_asked")
    # an odd number, so that each of the three code points in a key matters
    groups = max(LEAST_GROUPS, -(-model.counts.count() // GROUP_COUNTS),
                 -(-int(asked.agg(F.sum("asked")).first()[0] or 0) // GROUP_ASKED)) | 1
    known = model.counts.withColumn("grp", F.col("gram") % F.lit(groups).cast("long"))
    answers = known.groupBy("grp").cogroup(
        asked.select("block", "keys").mapInArrow(_dealt(groups), "block long, grp long, keys binary").groupBy("grp")
    ).applyInArrow(_answer(langs), "block long, gram binary, lang binary, n binary")

    def score(block: pa.Table, found: pa.Table) -> pa.Table:
        rows = list(zip(*(found.column(c).to_pylist() for c in ("gram", "lang", "n"))))
        counts = Counts(*(np.concatenate([np.zeros(0, np.int64), *x]) for x in (
            [np.cumsum(unpacked(g)) for g, _, _ in rows], [unpacked(x, np.int32) for _, x, _ in rows], [unpacked(n) for _, _, n in rows])))
        out = []
        for row in block.to_pylist():
            values, lang, share, met = text_values(row), [], [], []
            for a, b in chunks(row["size"], SCORED_BYTES):
                x, y, z = identify(values[a:b], langs, unknown, counts)
                lang += x
                share.append(y)
                met.append(z)
            *rest, null = rest_columns(row)
            rest.insert(at, pa.array(values, pa.binary(), mask=np.asarray(null.to_pylist(), bool)).cast(pa.string()))
            new = pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(np.concatenate(share)), pa.array(np.concatenate(met))],
                                             names=["lang", "score", "known"])
            out.append(pa.table([*rest, new], names=[*names, column]))
        return pa.concat_tables(out)       # every answer's block is there

    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, f"{fields}, `{column}` {RESULT}")
