"""Operator 1, BPE encoding and decoding with a segment tree over pair ranks.

The merges of a pre-token are driven by a segment tree over its adjacent
pairs: a leaf holds (rank, position) of the pair that starts there, an inner
node the smaller of its children, so the root is the leftmost pair of lowest
rank. A merge changes at most three leaves, each a logarithmic point update,
and the word is done when the root holds no mergeable pair. Short pre-tokens
run together, one tree per row of a numpy array (``_merge_rows``); a pre-token
over ROW_LIMIT bytes, such as a run of letters as long as its document, has a
tree of its own (``_merge_long``).

Text is cut at white space and every distinct piece is merged once per cache;
the cache is emptied when it holds CACHE_LIMIT entries, which changes speed,
never results. The vocabulary file is a parameter; it is read on the driver
and broadcast (some megabytes, whatever the data).

Defined cases: null text counts as empty and gives no ids; text is encoded
whole at any length; repeated rows and ties are independent rows; special
tokens in a text become their ids, as the vocabulary file says; an empty table
gives an empty result; other columns are ignored; a null id stays null.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from mediamart.llm.common import ship, slices, texts

ROW_LIMIT, ROWS_AT_ONCE, CACHE_LIMIT = 64, 40_000, 300_000
SHIFT = 8                      # bits of the position in a tree key; ROW_LIMIT < 1 << SHIFT
NONE = np.int64(1) << np.int64(60)
#: Separators that str.split() takes for white space and the vocabulary's normaliser does not.
CONTROL = "\x1c\x1d\x1e\x1f"
SPACE = regex.compile(r"[^\t-\r \x85\xa0  -     　]+")


def _byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


def _unassigned(text: str) -> bool:
    """Whether a character is newer than this Python's Unicode tables."""
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text))


class PairRanks:
    """(left id, right id) -> rank, by open addressing in two numpy arrays."""

    BITS = 18

    def __init__(self, pairs: list[tuple[int, int]]):
        self.keys = np.full(1 << self.BITS, -1, np.int64)
        self.ranks = np.zeros(1 << self.BITS, np.int64)
        self.probes, mask = 1, (1 << self.BITS) - 1
        for rank, (a, b) in enumerate(pairs):
            key = a << 20 | b
            at, n = int(self._slot(np.array([key]))[0]), 1
            while self.keys[at] != -1:
                at, n = (at + 1) & mask, n + 1
            self.keys[at], self.ranks[at] = key, rank
            self.probes = max(self.probes, n)
        self.plain = {p: rank for rank, p in enumerate(pairs)}

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE >> SHIFT where there is no merge."""
        key = left.astype(np.int64) << 20 | right
        at = self._slot(key)
        out = np.full(key.shape, NONE >> SHIFT, np.int64)
        seen = self.keys[at]
        hit = seen == key
        out[hit] = self.ranks[at[hit]]
        rest = np.flatnonzero(~hit & (seen != -1))
        for _ in range(self.probes - 1):
            if not len(rest):
                break
            at[rest] = (at[rest] + 1) & ((1 << self.BITS) - 1)
            seen = self.keys[at[rest]]
            hit = seen == key[rest]
            out[rest[hit]] = self.ranks[at[rest[hit]]]
            rest = rest[~hit & (seen != -1)]
        return out


class _Index(dict):
    """Numbers new keys as they are looked up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _newest(index: _Index, first: int) -> list:
    """The keys numbered from ``first`` on, in order."""
    return list(itertools.islice(reversed(index), len(index) - first))[::-1]


class _Lists:
    """Growing lists of ids in flat arrays."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 12, np.int32), 0
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(flat)] = flat
        self.start = np.concatenate([self.start, self.used + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.used += len(flat)

    def take(self, which: np.ndarray) -> np.ndarray:
        """The chosen lists after each other."""
        size = self.size[which]
        ends = np.cumsum(size)
        at = np.repeat(self.start[which] - (ends - size), size)
        at += np.arange(len(at))
        return self.flat[at]


class Bpe:
    def __init__(self, source: str):
        spec = json.loads(source)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + end] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = PairRanks([(vocab[a], vocab[b]) for a, b in merges])
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: s.encode() for s, i in [*vocab.items(), *self.special.items()]}
        self.special_at = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
        self.units = regex.compile(steps[0]["pattern"]["Regex"] + "| ")
        self.source, self.library = source, None
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.reset()

    def reset(self) -> None:
        """Forget all pieces seen."""
        self.pieces, self.words = _Index(), _Index()
        self.words[" "] = 0            # stands between two pieces
        self.word_ids, self.piece_ids = _Lists(), _Lists()
        self.word_ids.add(np.zeros(0, np.int32), np.zeros(1, np.int64))

    # -- one pre-token ----------------------------------------------------
    def _symbols(self, word: bytes) -> np.ndarray:
        b = np.frombuffer(word, np.uint8)
        out = self.inner[b]
        out[-1] = self.last[b[-1]]
        return out

    def _merge_long(self, word: bytes) -> list[int]:
        """One tree in a list; positions are linked, merged ones drop out."""
        sym = self._symbols(word).tolist()
        n = len(sym)
        leaves = 1 << max(1, (n - 1).bit_length())
        none = (1 << 62, 0)
        tree = [none] * (2 * leaves)
        rank, merged = self.rank.plain, self.merged
        for p in range(n - 1):
            r = rank.get((sym[p], sym[p + 1]))
            if r is not None:
                tree[leaves + p] = (r, p)
        for i in range(leaves - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n))

        def update(p: int, value: tuple[int, int]) -> None:
            i = leaves + p
            tree[i] = value
            i >>= 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                tree[i] = a if a < b else b
                i >>= 1

        def pair(p: int, q: int) -> tuple[int, int]:
            r = rank.get((sym[p], sym[q]))
            return none if r is None else (r, p)

        while tree[1] is not none and tree[1] != none:
            r, p = tree[1]
            q = after[p]
            sym[p], sym[q] = int(merged[r]), -1
            nxt = after[p] = after[q]
            if nxt < n:
                before[nxt] = p
            update(q, none)
            update(p, pair(p, nxt) if nxt < n else none)
            if before[p] >= 0:
                update(before[p], pair(before[p], p))
        return [s for s in sym if s >= 0]

    # -- many pre-tokens --------------------------------------------------
    def _merge_rows(self, words: list[bytes], leaves: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge words of at most leaves + 1 bytes, one segment tree per row.
        Returns the ids of all words after each other and each word's count."""
        n, width = len(words), leaves + 1
        size = np.fromiter(map(len, words), np.int64, n)
        flat = np.frombuffer(b"".join(words), np.uint8)
        row = np.repeat(np.arange(n), size)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        sym = np.full((n, width + 1), -1, np.int64)
        sym[row, col] = np.where(col == size[row] - 1, self.last[flat], self.inner[flat])
        after = np.broadcast_to(np.arange(1, width + 2), (n, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (n, width + 1)).copy()
        tree = np.full((n, 2 * leaves), NONE, np.int64)
        pairs = np.flatnonzero(col < size[row] - 1)
        r, c = row[pairs], col[pairs]
        tree[r, leaves + c] = np.minimum(self.rank(sym[r, c], sym[r, c + 1]) << SHIFT | c, NONE)
        level = leaves
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = np.arange(n)
        while True:
            root = tree[live, 1]
            live = live[root < NONE]
            if not len(live):
                break
            root = root[root < NONE]
            p = root & ((1 << SHIFT) - 1)
            q = after[live, p]
            new = self.merged[root >> SHIFT]
            sym[live, p], sym[live, q] = new, -1
            nxt = after[live, q]
            after[live, p] = nxt
            inside = nxt < size[live]
            before[live[inside], nxt[inside]] = p[inside]
            key = np.full(len(live), NONE)
            at = live[inside]
            key[inside] = np.minimum(self.rank(new[inside], sym[at, nxt[inside]]) << SHIFT | p[inside], NONE)
            tree[live, leaves + p] = key
            # the merged-away position starts no pair (the last one has no leaf)
            gone = q < leaves
            tree[live[gone], leaves + q[gone]] = NONE
            o = before[live, p]
            left = o >= 0
            at, ol = live[left], o[left]
            tree[at, leaves + ol] = np.minimum(self.rank(sym[at, ol], new[left]) << SHIFT | ol, NONE)
            rows = np.concatenate([live, live[gone], at])
            node = np.concatenate([leaves + p, leaves + q[gone], leaves + ol]) >> 1
            while node[0] >= 1:
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                node >>= 1
        kept = sym >= 0
        return sym[kept], kept.sum(1)

    def _learn(self, first: int) -> None:
        """Merge the pre-tokens numbered from ``first`` on and keep their ids."""
        words = [w.encode() for w in _newest(self.words, first)]
        size = np.fromiter(map(len, words), np.int64, len(words))
        # a tree has a power of two of leaves, one for each adjacent pair at least
        leaves = np.left_shift(1, np.ceil(np.log2(np.maximum(size - 1, 2))).astype(np.int64))
        leaves[size > ROW_LIMIT] = 0
        count = np.zeros(len(words), np.int64)
        parts, owner = [], []
        special = {s + " ": i for s, i in self.special.items()}   # marked by the blank
        for j in [j for j, w in enumerate(words) if w[-1:] == b" "]:
            leaves[j], count[j] = -1, 1
            parts.append(np.array([special[words[j].decode()]], np.int32))
            owner.append(np.array([j]))
        for n in np.unique(leaves[leaves >= 0]).tolist():
            group = np.flatnonzero(leaves == n)
            step = max(64, ROWS_AT_ONCE * 8 // n) if n else 1
            for i in range(0, len(group), step):
                part = group[i:i + step]
                if n:
                    got, sizes = self._merge_rows([words[j] for j in part.tolist()], n)
                else:
                    got = np.array(self._merge_long(words[int(part[0])]), np.int64)
                    sizes = np.array([len(got)])
                parts.append(got.astype(np.int32))
                owner.append(part)
                count[part] = sizes
        if parts:
            # groups come by length: put the ids back into the order of the words
            owner = np.concatenate(owner)
            flat = _Lists()
            flat.add(np.concatenate(parts), count[owner])
            back = np.empty(len(owner), np.int64)
            back[owner] = np.arange(len(owner))
            self.word_ids.add(flat.take(back), count)

    def _normalised(self, text: str) -> str:
        if not text.isascii():
            # lower case letter by letter: no final form of sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _pre_tokens(self, text: str) -> list[str]:
        if not _unassigned(text):
            return self.pattern.findall(self._normalised(text))
        # characters of a newer Unicode: ask the library how it cuts them
        if self.library is None:
            self.library = Tokenizer.from_str(self.source)
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in cut]

    def _resolve(self, first: int) -> None:
        """Ids of the pieces numbered from ``first`` on."""
        fresh = _newest(self.pieces, first)
        known, joined = len(self.words), " ".join(fresh)
        if _unassigned(joined) or self.special_at and self.special_at.search(joined):
            found = []
            for piece in fresh:
                a = 0
                for m in self.special_at.finditer(piece) if self.special_at else ():
                    found += self._pre_tokens(piece[a:m.start()])
                    found.append(m.group() + " ")       # no pre-token has a blank in it
                    a = m.end()
                found += [*self._pre_tokens(piece[a:]), " "]
        else:
            found = self.units.findall(self._normalised(joined))
            found.append(" ")
        word = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
        del found
        if len(self.words) > known:
            self._learn(known)
        upto = np.concatenate([[0], np.cumsum(self.word_ids.size[word])])
        ends = upto[np.flatnonzero(word == 0)]
        self.piece_ids.add(self.word_ids.take(word), np.diff(np.concatenate([[0], ends])))

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and each text's number of ids."""
        if len(self.pieces) > CACHE_LIMIT or len(self.words) > CACHE_LIMIT:
            self.reset()
        first, parts, counts, get = len(self.pieces), [], [], self.pieces.__getitem__
        for text in batch:
            pieces = SPACE.findall(text) if any(c in text for c in CONTROL) else text.split()
            parts.append(np.fromiter(map(get, pieces), np.int64, len(pieces)))
            counts.append(len(pieces))
        if len(self.pieces) > first:
            self._resolve(first)
        piece = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        upto = np.concatenate([[0], np.cumsum(self.piece_ids.size[piece])])
        upto = upto[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return self.piece_ids.take(piece).astype(np.uint32), np.diff(upto)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens with a blank between each two, special ones included."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[str, Bpe] = {}


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) of every text."""
    return _run(docs, path, id_col, text_col, decoded=False)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the text decoded from them."""
    return _run(docs, path, id_col, text_col, decoded=True)


def _run(docs: DataFrame, path: str, id_col: str, text_col: str, decoded: bool) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    with open(path, encoding="utf-8") as f:
        source = spark.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = tokenizer(source)
        for batch in batches:
            for part in slices(batch, 1):
                ids, size = bpe.encode(texts(part.column(1)))
                ends = np.cumsum(size)
                each = [ids[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]
                out = [part.column(0), pa.array([x.astype("<u4").tobytes() for x in each], pa.binary())]
                if decoded:
                    out.append(pa.array([bpe.decode(x) for x in each], pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "decoded"][:len(out)])
        bpe.reset()                     # the worker process stays, its memory should not

    rows = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text")
    return rows.mapInArrow(run, "doc_id long, ids binary" + (", decoded string" if decoded else ""))


def tokenizer(source) -> Bpe:
    """The tokenizer of a broadcast vocabulary file, kept per worker process."""
    key = source.value[:64] + str(len(source.value))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(source.value)
    return _LOADED[key]
