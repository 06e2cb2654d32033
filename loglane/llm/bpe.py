"""Byte-level BPE with a minimal acyclic transducer as lexicon.

1. The pre-tokens ("words") of all documents are counted by Spark; the
   ``LEXICON_WORDS`` most frequent ones form the lexicon.
2. The driver compiles them into a minimal acyclic automaton (shared prefixes
   and shared suffixes). Each transition carries a number; their sum along a
   word is the word's place in the table of id lists. The automaton is a flat
   file that every Python worker memory-maps.
3. Words not met before in a worker walk the automaton, all at once, and those
   that it lacks are merged exactly by merge rank (by a public library where the
   vocabulary's ranks are its ids, else by ``Vocabulary.merge``).
4. Decoding goes from ids to bytes to text (bad UTF-8 is replaced).

The special token's string in a text becomes its id, as the tokenizers library
does by default. The vocabulary file is a parameter; nothing is trained.

Defined results: null text is empty, with no ids and the digest of the empty
string; repeated rows are encoded alike; null ids and extra columns pass
through untouched.
"""

from __future__ import annotations

import hashlib
import json
import mmap
import os
import re
import unicodedata
from collections import Counter
from functools import cached_property, lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_file, pieces, read_table, scratch, ship_package

LEXICON_WORDS = 32_768
#: Entries a worker keeps of pieces met before, and of counts not yet sent.
CACHE_ENTRIES = 500_000
MAGIC = 0x4D414654
#: Ranges of characters whose class all Unicode versions since 4.1
#: agree on. Texts with others are split by the tokenizers library itself.
SURE = [(0x0, 0x24F), (0x370, 0x373), (0x391, 0x3A1), (0x3A3, 0x3CE), (0x400, 0x486), (0x48A, 0x4FF), (0x2000, 0x2063),
        (0x20A0, 0x20B5), (0x2100, 0x214C), (0x2190, 0x23DB), (0x2460, 0x2604), (0x3000, 0x303F), (0x3041, 0x3096),
        (0x30A0, 0x30FF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xFF01, 0xFF5E)]
UNSURE = re.compile("[^" + "".join(f"{re.escape(chr(a))}-{chr(b)}" for a, b in SURE) + "]")


def _class(kind) -> str:
    """The characters of ``SURE`` that ``kind`` holds for, as ranges of a pattern class."""
    out, start = [], None
    for a, b in SURE:
        for c in range(a, b + 2):
            inside = c <= b and kind(chr(c))
            if inside and start is None:
                start = c
            elif not inside and start is not None:
                out.append(f"{re.escape(chr(start))}-{re.escape(chr(c - 1))}")
                start = None
    return "".join(out)


@lru_cache(maxsize=1)
def word_pattern() -> re.Pattern:
    """The byte-level pre-token pattern with its classes spelled out, for texts
    of ``SURE`` characters: the standard module runs it over twice as fast as
    one that knows Unicode classes by name."""
    letter = _class(lambda c: unicodedata.category(c)[0] == "L")
    number = _class(lambda c: unicodedata.category(c)[0] == "N")
    space = _class(lambda c: c in "\t\n\x0b\x0c\r\x85" or unicodedata.category(c)[0] == "Z")
    return re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
                      f"|[{space}]+(?![^{space}])|[{space}]+")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it prints, else the next code point from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Vocabulary:
    """Pre-token splitting and exact merging by a vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model, own = spec["model"], {c: b for b, c in byte_letters().items()}
        vocab = model["vocab"]
        self.ids = {bytes(own[c] for c in w): i for w, i in vocab.items() if all(c in own for c in w)}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: w for w, i in self.ids.items()} | {i: s.encode() for s, i in self.specials.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.decimal = {i: str(i) for i in self.bytes_of}
        self._findall = word_pattern().findall
        self._pre = Tokenizer.from_file(path).pre_tokenizer

    def split(self, text: str) -> list[str]:
        """Pre-tokens."""
        if text.isascii() or not UNSURE.search(text):
            return self._findall(text)
        return [text[a:b] for _, (a, b) in self._pre.pre_tokenize_str(text)]

    @cached_property
    def library(self):
        """A fast encoder of the same vocabulary for texts without unsure
        characters, or None if the merge ranks are not the order of ids."""
        import public_tokenizers
        import tiktoken

        if [new for _, new in self.ranks.values()] != list(range(256, 256 + len(self.ranks))):
            return None
        return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ids, special_tokens={})

    def merger(self):
        """Merges one word exactly as ``merge`` does, faster; None without ``library``."""
        return self.library.encode_ordinary if self.library else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: always the leftmost pair of lowest rank first
        (a heap and linked neighbours)."""
        from heapq import heapify, heappop, heappush

        ids, ranks = [self.single[b] for b in word], self.ranks
        n = len(ids)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(ranks[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = right[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], right[i] = ranks[a, b][1], -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (p := (ids[x], ids[y])) in ranks:
                    heappush(heap, (ranks[p][0], x, *p))
        return [x for x in ids if x >= 0]


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The flat file of the minimal acyclic transducer of ``entries``.

    Words go in sorted order; when the next word leaves a branch, the branch's
    states are replaced by equal ones already registered (same finality and
    same transitions), which shares suffixes."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []  # registered: final, ((byte, state), ...)
    path: list[list] = [[False, {}]]  # open states along the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, tuple(edges.items()))
            if key not in register:
                register[key] = len(states)
                states.append(key)
            path[-1][1][last[len(path) - 1]] = register[key]

    for w in words:
        common = len(os.path.commonprefix([w, last]))
        close(common)
        path.extend([False, {}] for _ in w[common:])
        path[-1][0], last = True, w
    close(0)
    states.append((path[0][0], tuple(path[0][1].items())))
    root = len(states) - 1

    below = [0] * len(states)  # words from each state on; targets are registered first
    keys, targets, adds = [], [], []
    for s, (final, edges) in enumerate(states):
        n = int(final)
        for b, t in sorted(edges):
            keys.append(s << 8 | b)
            targets.append(t)
            adds.append(n)
            n += below[t]
        below[s] = n
    lists = [entries[w] for w in words]
    starts = np.cumsum([0, *map(len, lists)])
    parts = [np.array([MAGIC, len(keys), len(states), len(words), root], np.int64),
             np.array(keys, np.int64), np.array(targets, np.int64), np.array(adds, np.int64),
             np.array([f for f, _ in states], np.int64), starts.astype(np.int64),
             np.array(list(chain.from_iterable(lists)), np.int64)]
    return b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as fh:
            flat = np.frombuffer(mmap.mmap(fh.fileno(), 0, access=mmap.ACCESS_READ), np.int64)
        magic, n_edges, n_states, n_words, self.root = map(int, flat[:5])
        if magic != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        cuts = np.cumsum([5, n_edges, n_edges, n_edges, n_states, n_words + 1])
        self.keys, self.targets, self.adds, self.final, self.starts, self.ids = np.split(flat, cuts)[1:]
        self.n_words, self.n_states = n_words, n_states

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the table of id lists, or -1."""
        n = len(words)
        lens = np.fromiter(map(len, words), np.int64, n)
        where = np.full(n, -1, np.int64)
        if not len(self.keys) or not n:
            return where
        data, starts = np.frombuffer(b"".join(words), np.uint8), np.cumsum(lens) - lens
        live = np.flatnonzero(lens > 0)
        state, place = np.full(len(live), self.root), np.zeros(len(live), np.int64)
        depth = 0
        while len(live):
            key = state << 8 | data[starts[live] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[at] == key
            live, at = live[ok], at[ok]
            state, place = self.targets[at], place[ok] + self.adds[at]
            depth += 1
            ended = lens[live] == depth
            done = ended & (self.final[state] == 1)
            where[live[done]] = place[done]
            live, state, place = live[~ended], state[~ended], place[~ended]
        return where

    def ids_at(self, place: int) -> list[int]:
        return self.ids[self.starts[place]:self.starts[place + 1]].tolist()


class Encoder:
    """Encodes and decodes texts, remembering words met before."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str, tuple] = {}  # word: (ids as decimal text, count, bytes that they decode to)
        self.special = next(iter(vocabulary.specials), None)

    def learn(self, words: list[str]) -> list[tuple]:
        v, raw = self.vocabulary, [w.encode() for w in words]
        ids: list = [None] * len(raw)
        places = self.lexicon.find(raw) if self.lexicon else np.full(len(raw), -1)
        unseen = np.flatnonzero(places < 0).tolist()
        for i in np.flatnonzero(places >= 0).tolist():
            ids[i] = self.lexicon.ids_at(int(places[i]))
        fast = v.merger()
        for i in unseen:
            sure = words[i].isascii() or not UNSURE.search(words[i])
            ids[i] = fast(words[i]) if fast and sure else v.merge(raw[i])
        of, name = v.bytes_of, v.decimal
        return [(name[g[0]], 1, of[g[0]]) if len(g) == 1 else
                (",".join([name[i] for i in g]), len(g), b"".join([of[i] for i in g])) for g in ids]

    def encode_all(self, texts: list[str]) -> list[list[tuple]]:
        """Per text its encoded words, in order."""
        split, special = self.vocabulary.split, self.special
        plans = []
        for text in texts:
            if special and special in text:
                bits = [x for p in text.split(special) for x in (p, special)][:-1]
                plans.append([w for p in bits for w in ([p] if p == special else split(p))])
            else:
                plans.append(split(text))
        if special and special not in self.known:
            self.known[special] = (str(self.vocabulary.specials[special]), 1, special.encode())
        # one look-up a word; only those not met before are gathered and looked up again
        known = self.known.get
        out = [list(map(known, p)) for p in plans]
        missing = [i for i, got in enumerate(out) if None in got]
        if missing:
            new = list({w for i in missing for w, g in zip(plans[i], out[i]) if g is None})
            learned = dict(zip(new, self.learn(new)))
            for i in missing:
                out[i] = [learned[w] if g is None else g for w, g in zip(plans[i], out[i])]
            if len(self.known) + len(new) > CACHE_ENTRIES:
                self.known.clear()
            self.known.update(learned)
        return out


@lru_cache(maxsize=2)
def vocabulary_of(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def library_of(path: str):
    return vocabulary_of(path).library


@lru_cache(maxsize=2)
def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_OPEN: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, lexicon: str) -> Encoder:
    """The encoder of this worker, kept between tasks."""
    if (vocabulary, lexicon) not in _OPEN:
        _OPEN.clear()
        _OPEN[vocabulary, lexicon] = Encoder(vocabulary_of(vocabulary), Lexicon(SparkFiles.get(lexicon)))
    return _OPEN[vocabulary, lexicon]


def word_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(word, n): how often each pre-token of at most 48 characters occurs.
    Longer ones are left to exact merging."""

    def count(batches):
        v, seen = vocabulary_of(vocabulary), Counter()

        def flush():
            few = [(w, n) for w, n in seen.items() if len(w) <= 48]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in few], pa.string()),
                                               pa.array([n for _, n in few], pa.int64())], ["word", "n"])

        special = next(iter(v.specials), None)
        for b in pieces(batches, text):
            for t in b.column(0).to_pylist():
                for part in (t or "").split(special) if special else [t or ""]:
                    seen.update(v.split(part))
            if len(seen) > CACHE_ENTRIES:
                yield flush()
        yield flush()

    return (docs.select(text).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocabulary: str, size: int = LEXICON_WORDS, text: str = "text") -> str:
    """Compile the ``size`` most frequent words and hand the file to all
    executors; returns its name there."""
    spark = docs.sparkSession
    top = word_counts(docs, vocabulary, text).orderBy(F.desc("n"), "word").limit(size)
    v = vocabulary_of(vocabulary)
    words = [r["word"].encode() for r in top.toLocalIterator()]
    flat = compile_lexicon({w: v.merge(w) for w in words})
    uri = scratch(spark, "lexicon") + ".bin"
    with open_file(uri, write=True) as out:
        out.write(flat)
    spark.sparkContext.addFile(uri)
    return uri.rpartition("/")[2]


def encode_decode(docs: DataFrame, vocabulary: str | None = None, size: int = LEXICON_WORDS,
                  with_ids: bool = True) -> DataFrame:
    """Per document (doc_id): n_tokens, ids_sha256, decoded_sha256 and, if
    asked for, ids (array of int) and decoded (string)."""
    ship_package(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    rows = docs.select("doc_id", "text")
    lexicon = build_lexicon(rows, vocabulary, size)
    ddl = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ddl += ", ids array<int>, decoded string" if with_ids else ""

    def run(batches):
        e, name_of, bytes_of = encoder(vocabulary, lexicon), itemgetter(0), itemgetter(2)
        for b in pieces(batches, "text"):
            counts, id_sums, text_sums, ids, decoded = [], [], [], [], []
            for got in e.encode_all([t or "" for t in b.column(1).to_pylist()]):
                joined = ",".join(map(name_of, got))
                back = b"".join(map(bytes_of, got)).decode("utf-8", "replace")
                counts.append(joined.count(",") + 1 if joined else 0)
                id_sums.append(hashlib.sha256(joined.encode()).hexdigest())
                text_sums.append(hashlib.sha256(back.encode()).hexdigest())
                if with_ids:
                    ids.append([int(x) for x in joined.split(",")] if joined else [])
                    decoded.append(back)
            arrays = [b.column(0), pa.array(counts, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return rows.mapInArrow(run, ddl)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), with_ids=False)
