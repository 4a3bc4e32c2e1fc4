"""Which tokens of two vocabularies stand for the same bytes, and how often in a corpus: counts under a minimal perfect hash.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B), both over a space and the text. Places where a
token of A and one of B end together cut it into groups; every token of A in a group is linked with every one of B in it. The
count of a pair of ids is the number of documents that have it linked.

Both vocabularies end a token before a space that follows a visible character: the pre-token pattern of A always, and B as long as
none of its pieces holds a space behind another character, which is looked at. So a text is aligned word by word, and each
task keeps the words that it has aligned. With a B that has such pieces texts are aligned as a whole.

The first pass aligns all documents and writes, for each task, its distinct pairs with the number of its documents. The distinct
pairs of all tasks are spread over shards of some ``SHARD_KEYS``, and each shard gets a minimal perfect hash and its keys in
hash order. Counts are dense vectors indexed by that hash: in each shard, ``SALTS`` tasks stream their part of the written pairs
into a vector of their own, and the vectors of a shard are summed. A task holds one vector, however many rows a pair has.

The second pass aligns the documents again and looks the counts up in hashes, keys and counts that are broadcast; a key that is not the
one kept at its number is no key of the table. The most counted pairs are broadcast, at most ``LOOKUP_KEYS`` of them (some 17 bytes
each); with more pairs in the corpus a third pass sends the links of the others to the counts by a join.

The driver reads both vocabularies from files named by parameters and broadcasts them, some two megabytes; it collects the
highest count of each A id, a row for each id of the vocabulary at most.

Defined cases: null and empty texts, and texts whose pieces do not spell a space and the text (a text with U+2581, which B reads as a
space), have no tokens: zeros and an empty ``groups``. Every row counts as a document of its own, so repeated rows count. Long texts
are read whole; documents are aligned in blocks of some ``BLOCK_CHARS``, large groups are linked by distinct ids with
multiplicities, and a task forgets its words when they are more than ``HELD_WORDS`` or ``HELD_CHARS``. Only doc_id and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow
from bulkapply.llm.perfect_hash import PerfectHash, build
from bulkapply.llm.token_counts import PATTERN, VOCABULARY, vocabulary
from bulkapply.storage import materialize

# The ranks file holds the same vocabulary as the tokenizer file byte_bpe_50k.json.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SHARD_KEYS = 65_536
SALTS = 8
LOOKUP_KEYS = 4_000_000
BLOCK_CHARS = 1_000_000
HELD_WORDS, HELD_CHARS = 300_000, 20_000_000
# Groups of more links are reduced to distinct ids first.
LARGE_GROUP = 4096
_HELD = 4_000_000
# A pair is A's id, then B's in 20 bits.
_B_BITS = 20
_SPREAD = 7919


_CUT, _BLANKS = re.compile(r"(?<=\S) "), re.compile(r"\A |\s ")
# Words that are encoded in one go.
_TOGETHER = 256


@dataclass
class Alignment:
    """Tokens of several texts, and the groups: where each begins among A's and B's tokens, and its text (``doc``)."""

    n_docs: int
    a: np.ndarray
    b: np.ndarray
    a_of: np.ndarray
    b_of: np.ndarray
    from_a: np.ndarray
    from_b: np.ndarray
    doc: np.ndarray

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.from_a), np.diff(self.from_b)

    def per_doc(self, of_groups: np.ndarray) -> np.ndarray:
        """Sums over the groups of each document."""
        out = np.zeros(self.n_docs, np.int64)
        np.add.at(out, self.doc, of_groups)
        return out

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``doc, pair, times``: the distinct linked pairs of each document with their number of links."""
        in_a, in_b = self.sizes
        n_links = in_a * in_b
        small = np.flatnonzero(n_links <= LARGE_GROUP)
        of_group = np.repeat(small, n_links[small])
        within = np.arange(len(of_group)) - np.repeat(np.cumsum(n_links[small]) - n_links[small], n_links[small])
        a = self.a[self.from_a[of_group] + within // in_b[of_group]]
        b = self.b[self.from_b[of_group] + within % in_b[of_group]]
        docs, pairs, times = [self.doc[of_group]], [a << _B_BITS | b], [np.ones(len(a), np.int64)]
        for group in np.flatnonzero(n_links > LARGE_GROUP):
            ids_a, n_a = np.unique(self.a[self.from_a[group] : self.from_a[group + 1]], return_counts=True)
            ids_b, n_b = np.unique(self.b[self.from_b[group] : self.from_b[group + 1]], return_counts=True)
            pairs.append((ids_a[:, None] << _B_BITS | ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
            docs.append(np.full(len(pairs[-1]), self.doc[group]))
        return _summed(np.concatenate(docs), np.concatenate(pairs), np.concatenate(times))

    def groups(self) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
        in_a, in_b = self.sizes
        width = len(str(max(self.a.max(initial=0), self.b.max(initial=0))))
        at_a = np.arange(len(self.a)) + np.repeat(self.from_b[:-1], in_a)
        at_b = np.arange(len(self.b)) + np.repeat(self.from_a[1:], in_b)
        cells = np.zeros((len(self.a) + len(self.b), width + 1), np.uint8)
        cells[at_a, :width], cells[at_a, width] = _digits(self.a, width), ord(",")
        cells[at_b, :width], cells[at_b, width] = _digits(self.b, width), ord(",")
        if len(self.doc):
            cells[at_a[self.from_a[1:] - 1], width] = ord("|")
            last = self.from_b[1:] - 1
            cells[at_b[last], width] = np.where(np.r_[self.doc[1:] == self.doc[:-1], False], ord(";"), 0)
        text = cells[cells != 0].tobytes().decode()
        ends = np.r_[0, np.cumsum((cells != 0).sum(axis=1))]
        cut = ends[np.r_[0, np.cumsum(self.a_of + self.b_of)]].tolist()
        return [text[x:y] for x, y in zip(cut, cut[1:])]


def _digits(ids: np.ndarray, width: int) -> np.ndarray:
    """Decimal digits in ``width`` bytes, zero bytes in front."""
    powers = 10 ** np.arange(width - 1, -1, -1)
    leading = (ids[:, None] >= powers) | (powers == 1)
    return np.where(leading, ids[:, None] // powers % 10 + ord("0"), 0)


def _summed(docs: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    both = docs << 2 * _B_BITS | pairs
    order = np.argsort(both)
    both, times = both[order], times[order]
    begin = np.flatnonzero(np.r_[True, both[1:] != both[:-1]][: len(both)])
    both = both[begin]
    return both >> 2 * _B_BITS, both & (1 << 2 * _B_BITS) - 1, np.add.reduceat(times, begin) if len(begin) else times


class Aligner:
    """Both tokenizers, from the ranks of one and the serialised model of the other."""

    def __init__(self, ranks: dict[bytes, int], pieces: bytes, pattern: str = PATTERN):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("byte-bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.bytes_a = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.bytes_a[i] = len(token)
        self.spelt = [self._bytes(i) for i in range(self.b.vocab_size())]
        self.bytes_b = np.array([*map(len, self.spelt)], np.int64)
        self.blank = self.b.piece_to_id("\u2581")
        # Whether B, as A, always ends a token before a space behind another character.
        self.by_word = self.spelt[self.blank] == b" " and not any(b" " in each.lstrip(b" ") for each in self.spelt)

    def _bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()

    def align(self, texts: list[str]) -> tuple[Alignment, np.ndarray]:
        """Each text behind a space; one that its pieces do not spell has no tokens, and is told by the second result."""
        ids_a = [self.a.encode_ordinary(" " + text) for text in texts]
        ids_b = [b if text else [self.blank] for text, b in zip(texts, self.b.encode(texts, num_threads=1))]
        spelt = self.spelt.__getitem__
        valid = np.array([b"".join(map(spelt, b)) == b" " + text.encode() for text, b in zip(texts, ids_b)], bool)
        for i in np.flatnonzero(~valid).tolist():
            ids_a[i], ids_b[i] = [], []
        a_of, b_of = (np.array([*map(len, ids)], np.int64) for ids in (ids_a, ids_b))
        a, b = (np.fromiter((x for each in ids for x in each), np.int64, int(n.sum())) for ids, n in ((ids_a, a_of), (ids_b, b_of)))
        return self._grouped(len(texts), a, b, a_of, b_of), valid

    def align_words(self, words: list[str]) -> tuple[Alignment, np.ndarray]:
        """The same for words that end in visible characters, encoded in one go: no token crosses from one to the next."""
        parts = [" ".join(words[i : i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        a = [i for part in parts for i in self.a.encode_ordinary(" " + part)]
        b = [i for part in self.b.encode(parts, num_threads=1) for i in part]
        if b"".join(map(self.spelt.__getitem__, b)) != "".join([" " + part for part in parts]).encode():
            return self.align(words)
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum([1 + len(word.encode()) for word in words])
        a_of, b_of = (np.diff(np.searchsorted(np.cumsum(size[ids]), ends, "right"), prepend=0) for size, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        return self._grouped(len(words), a, b, a_of, b_of), np.ones(len(words), bool)

    def _grouped(self, n_texts: int, a: np.ndarray, b: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> Alignment:
        # Ends of tokens in bytes from the start of the first text; both reach each text's own end.
        ends_a, ends_b = np.cumsum(self.bytes_a[a]), np.cumsum(self.bytes_b[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        from_a = np.r_[0, np.searchsorted(ends_a, common) + 1]
        from_b = np.r_[0, np.searchsorted(ends_b, common) + 1]
        doc = np.searchsorted(np.cumsum(a_of), from_a[1:])
        return Alignment(n_texts, a, b, a_of, b_of, from_a, from_b, doc)


def _words(text: str) -> list[str]:
    """A text cut before each space that follows a visible character, without these spaces."""
    return _CUT.split(text) if _BLANKS.search(text) else text.split(" ")


class Words:
    """The words aligned so far, numbered; a text that must be aligned as a whole is a word of its own, in a tuple."""

    def __init__(self, aligner: Aligner, lookup: Lookup | None = None, spell: bool = True):
        self.aligner, self.lookup, self.spell = aligner, lookup, spell
        self._clear()

    def _clear(self) -> None:
        none = np.empty(0, np.int64)
        self.number: dict = {}
        self.groups: list[str] = []
        self.chars, self.spelt = 0, np.empty(0, bool)
        # Per word: tokens of A and B, groups, links, best links, counts of all links; then its distinct pairs, one word after another.
        self.sums = np.empty((0, 6), np.int64)
        self.pairs, self.times, self.begin = none, none, np.zeros(1, np.int64)

    def _add(self, keys: list, texts: list[str], aligned: Alignment, spelt: np.ndarray) -> None:
        in_a, in_b = aligned.sizes
        word, pairs, times = aligned.links()
        sums = np.zeros((len(texts), 6), np.int64)
        sums[:, 0], sums[:, 1] = aligned.a_of, aligned.b_of
        sums[:, 2], sums[:, 3] = aligned.per_doc(np.ones(len(in_a), np.int64)), aligned.per_doc(in_a * in_b)
        if self.spell:
            self.groups += aligned.groups()
        if self.lookup is not None:
            counts = self.lookup.counts(pairs)
            np.add.at(sums[:, 4], word, times * (counts == self.lookup.best[pairs >> _B_BITS]))
            np.add.at(sums[:, 5], word, times * np.maximum(counts, 0))
        self.number.update(zip(keys, range(len(self.number), len(self.number) + len(keys))))
        self.chars += sum(map(len, texts))
        self.spelt, self.sums = np.r_[self.spelt, spelt], np.r_[self.sums, sums]
        self.pairs, self.times = np.r_[self.pairs, pairs], np.r_[self.times, times]
        self.begin = np.r_[self.begin, self.begin[-1] + np.cumsum(np.bincount(word, minlength=len(texts)))]

    def of(self, texts: list[str | None]) -> Texts:
        """The words of each text. A text with a word that its pieces do not spell is aligned as a whole."""
        if len(self.number) > HELD_WORDS or self.chars > HELD_CHARS:
            self._clear()
        cut = [(_words(text) if self.aligner.by_word else [(text,)]) if text else [] for text in texts]
        flat = self._numbers([word for words in cut for word in words])
        sizes = np.array([*map(len, cut)], np.int64)
        doc = np.repeat(np.arange(len(cut)), sizes)
        odd = np.unique(doc[~self.spelt[flat]]).tolist() if self.aligner.by_word else []
        if odd:
            for i in odd:
                cut[i], sizes[i] = [(texts[i],)], 1
            flat = self._numbers([word for words in cut for word in words])
            doc = np.repeat(np.arange(len(cut)), sizes)
        return Texts(self, len(texts), flat, doc)

    def _numbers(self, words: list) -> np.ndarray:
        new = [word for word in dict.fromkeys(words) if word not in self.number]
        visible = [word for word in new if type(word) is str and word and not word[-1].isspace()]
        if visible:
            self._add(visible, visible, *self.aligner.align_words(visible))
        rest = [word for word in new if word not in self.number]
        if rest:
            texts = [word if type(word) is str else word[0] for word in rest]
            self._add(rest, texts, *self.aligner.align(texts))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


@dataclass
class Texts:
    """Several texts by the numbers of their words, and the text (``doc``) of each."""

    words: Words
    n_docs: int
    flat: np.ndarray
    doc: np.ndarray

    def sums(self) -> np.ndarray:
        """The six sums of each text's words."""
        running = np.r_[np.zeros((1, 6), np.int64), np.cumsum(self.words.sums[self.flat], axis=0)]
        ends = np.searchsorted(self.doc, np.arange(self.n_docs + 1))
        return running[ends[1:]] - running[ends[:-1]]

    def groups(self) -> list[str]:
        parts = [self.words.groups[i] for i in self.flat.tolist()]
        ends = np.searchsorted(self.doc, np.arange(self.n_docs + 1)).tolist()
        return [";".join(parts[x:y]) for x, y in zip(ends, ends[1:])]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``doc, pair, times``: the distinct linked pairs of each text with their number of links."""
        known = self.words
        both, times = np.unique(self.doc << 32 | self.flat, return_counts=True)
        doc, word = both >> 32, both & (1 << 32) - 1
        n = known.begin[word + 1] - known.begin[word]
        at = np.repeat(known.begin[word] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return _summed(np.repeat(doc, n), known.pairs[at], np.repeat(times, n) * known.times[at])


def _blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Consecutive texts of some ``BLOCK_CHARS`` characters, as first and last index."""
    begin, n = 0, 0
    for i, text in enumerate(texts):
        n += len(text or "")
        if n >= BLOCK_CHARS:
            yield begin, i + 1
            begin, n = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


@dataclass
class Vocabularies:
    """Both vocabularies, broadcast."""

    ranks: object
    pieces: object
    pattern: str

    def aligner(self) -> Aligner:
        return Aligner(self.ranks.value, self.pieces.value, self.pattern)


def vocabularies(spark: SparkSession, path_a: str = VOCABULARY, path_b: str = PIECES, pattern: str = PATTERN) -> Vocabularies:
    with open(path_b, "rb") as model:
        return Vocabularies(vocabulary(spark, path_a), spark.sparkContext.broadcast(model.read()), pattern)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def pairs_of_tasks(docs: DataFrame, vocabs: Vocabularies) -> DataFrame:
    """``pair, n_docs`` of each task's documents; a task with very many pairs sends them in several portions."""

    def first_pass(batches):
        words, held, n = Words(vocabs.aligner(), spell=False), [], 0
        none = np.empty(0, np.int64)

        def merged():
            pairs = np.concatenate([none, *(p for p, _ in held)])
            times = np.concatenate([none, *(t for _, t in held)])
            _, pairs, times = _summed(np.zeros(len(pairs), np.int64), pairs, times)
            return [pairs, times]

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for x, y in _blocks(texts):
                _, pairs, _ = words.of(texts[x:y]).links()
                held.append(np.unique(pairs, return_counts=True))
                n += len(held[-1][0])
                if n >= _HELD:
                    held = [merged()]
                    n = len(held[0][0])
                    if n >= _HELD // 2:
                        yield held[0]
                        held, n = [], 0
        yield merged()

    return in_arrow(docs.select("text"), first_pass, "pair long, n_docs long")


def _shard(n_shards: int) -> Column:
    a, b = F.call_function("shiftright", F.col("pair"), F.lit(_B_BITS)), F.col("pair").bitwiseAND(F.lit((1 << _B_BITS) - 1))
    return F.pmod(a * _SPREAD + b, F.lit(n_shards)).cast("int")


def _shards_of(pairs: np.ndarray, n_shards: int) -> np.ndarray:
    return ((pairs >> _B_BITS) * _SPREAD + (pairs & (1 << _B_BITS) - 1)) % n_shards


def perfect_hashes(pairs: DataFrame) -> tuple[DataFrame, int]:
    """``shard, levels, pairs`` for the distinct ``pair`` of a written table, pairs in the order of their numbers; and how many shards."""
    distinct = materialize(pairs.select("pair").distinct(), "pairs")
    n_shards = distinct.count() // SHARD_KEYS + 1

    def hashed(shard: pd.DataFrame) -> pd.DataFrame:
        keys = np.sort(shard["pair"].to_numpy(np.int64))
        levels = build(keys)
        in_order = np.empty_like(keys)
        in_order[PerfectHash(levels).number(keys)] = keys
        return pd.DataFrame({"shard": [shard["shard"].iloc[0]], "levels": [levels], "pairs": [in_order]})

    sharded = distinct.withColumn("shard", _shard(n_shards)).groupBy("shard")
    return materialize(sharded.applyInPandas(hashed, "shard int, levels array<binary>, pairs array<long>"), "hashes"), n_shards


def counted(pairs: DataFrame, hashes: DataFrame, n_shards: int, salts: int = SALTS) -> DataFrame:
    """``shard, counts``: the documents of each pair, by its number; vectors of ``salts`` tasks for each shard, then their sum."""
    salt = F.pmod(F.xxhash64("pair", "n_docs"), F.lit(salts)).cast("int")
    rows = pairs.select(_shard(n_shards).alias("shard"), salt.alias("salt"), F.lit(None).cast("array<binary>").alias("levels"), "pair", "n_docs")
    heads = hashes.select("shard", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "levels",
                          F.lit(0).cast("long").alias("pair"), F.lit(0).cast("long").alias("n_docs"))
    # Each shard's hash comes first, then the rows that it numbers.
    dealt = rows.union(heads).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.isnull("levels"))

    def count(batches):
        shard, hash_, vector = None, None, None
        for batch in batches:
            head = batch.column("levels").is_valid().to_numpy(zero_copy_only=False)
            keys, n_docs = (batch.column(c).to_numpy() for c in ("pair", "n_docs"))
            edges = [0, *np.flatnonzero(head).tolist(), len(head)]
            for x, y in zip(edges, edges[1:]):
                if x < len(head) and head[x]:
                    if shard is not None:
                        yield [[shard], [vector]]
                    shard, hash_ = batch.column("shard")[x].as_py(), PerfectHash(batch.column("levels")[x].as_py())
                    vector = np.zeros(hash_.size, np.int64)
                    x += 1
                if x < y:
                    np.add.at(vector, hash_.number(keys[x:y]), n_docs[x:y])
        if shard is not None:
            yield [[shard], [vector]]

    def add(batches):
        last, total = None, None
        for batch in batches:
            for shard, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                vector = vector.values.to_numpy()
                if shard != last:
                    if last is not None:
                        yield [[last], [total]]
                    last, total = shard, np.zeros(len(vector), np.int64)
                total += vector
        if last is not None:
            yield [[last], [total]]

    vectors = in_arrow(dealt, count, "shard int, counts array<long>")
    return in_arrow(vectors.repartition("shard").sortWithinPartitions("shard"), add, "shard int, counts array<long>")


class Lookup:
    """Counts of pairs by perfect hashing, from ``(shard, levels, pairs, counts)``."""

    def __init__(self, n_shards: int, shards: dict[int, tuple], best: np.ndarray):
        self.n_shards, self.best = n_shards, best
        self.shards = {s: (PerfectHash(levels), keys, counts) for s, (levels, keys, counts) in shards.items()}

    def counts(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair; -1 if the table does not have it."""
        out, shard = np.full(len(pairs), -1, np.int64), _shards_of(pairs, self.n_shards)
        for s in np.unique(shard).tolist():
            if s in self.shards:
                at = np.flatnonzero(shard == s)
                hash_, keys, counts = self.shards[s]
                number = hash_.number(pairs[at])
                known = (number >= 0) & (keys[number] == pairs[at])
                out[at[known]] = counts[number[known]]
        return out


def _with_counts(hashes: DataFrame, counts: DataFrame) -> DataFrame:
    """``pair, n_docs`` of every distinct pair."""
    both = hashes.join(counts, "shard").select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    return both.select(F.col("x.pairs").alias("pair"), F.col("x.counts").alias("n_docs"))


def _least_count(table: DataFrame, most: int) -> int:
    """The power of two from which on at most ``most`` pairs are counted as often; 0 if all pairs are few enough."""
    sizes = {r.power: r["count"] for r in table.groupBy(F.floor(F.log2("n_docs")).cast("int").alias("power")).count().collect()}
    if sum(sizes.values()) <= most:
        return 0
    fitting, n = max(sizes) + 1, 0
    for power in sorted(sizes, reverse=True):
        n += sizes[power]
        if n > most:
            break
        fitting = power
    return 1 << fitting


def align(docs: DataFrame, path_a: str = VOCABULARY, path_b: str = PIECES, pattern: str = PATTERN,
          lookup_keys: int = LOOKUP_KEYS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every row.

    ``n_best`` counts the links whose count is the highest of their A id, ``count_sum`` sums the counts of all links.
    """
    spark = docs.sparkSession
    vocabs = vocabularies(spark, path_a, path_b, pattern)
    texts = _texts(docs)
    pairs = materialize(pairs_of_tasks(texts, vocabs), "pairs-of-tasks")
    hashes, n_shards = perfect_hashes(pairs)
    counts = materialize(counted(pairs, hashes, n_shards), "counts")
    table = materialize(_with_counts(hashes, counts), "pair-counts")
    a_id = F.call_function("shiftright", F.col("pair"), F.lit(_B_BITS)).cast("int")
    highest = {r.a: r.most for r in table.groupBy(a_id.alias("a")).agg(F.max("n_docs").alias("most")).collect()}
    best = np.zeros(max(highest, default=0) + 1, np.int64)
    best[list(highest)] = list(highest.values())

    least = _least_count(table, lookup_keys)
    if least:
        frequent = materialize(table.where(F.col("n_docs") >= least), "frequent-pairs")
        hashes, n_shards = perfect_hashes(frequent)
        counts = materialize(counted(frequent, hashes, n_shards), "frequent-counts")
    rows = hashes.join(counts, "shard").select("shard", "levels", "pairs", "counts").toArrow()
    shards = {shard.as_py(): (levels.as_py(), pairs.values.to_numpy(), vector.values.to_numpy())
              for shard, levels, pairs, vector in zip(*rows.columns)}
    known = spark.sparkContext.broadcast((n_shards, shards, best))
    found = _second_pass(texts, vocabs, known)
    if least:
        found = _with_rare(found, texts, vocabs, known, table.where(F.col("n_docs") < least))
    return found.drop("text_hash")


def _second_pass(texts: DataFrame, vocabs: Vocabularies, known) -> DataFrame:
    def look_up(batches):
        words = Words(vocabs.aligner(), Lookup(*known.value))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for x, y in _blocks(texts):
                found = words.of(texts[x:y])
                yield [batch.column(0).slice(x, y - x), batch.column(2).slice(x, y - x), *found.sums().T, found.groups()]

    numbers = ", ".join(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"))
    return in_arrow(texts.select("doc_id", "text", "text_hash"), look_up, f"doc_id long, text_hash long, {numbers}, groups string")


def _with_rare(found: DataFrame, texts: DataFrame, vocabs: Vocabularies, known, rare: DataFrame) -> DataFrame:
    """``found`` with the links whose pairs are not broadcast: they go to the rest of the table by a join."""

    def unknown(batches):
        lookup = Lookup(*known.value)
        words = Words(vocabs.aligner(), spell=False)
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(2)
            texts = batch.column(1).to_pylist()
            for x, y in _blocks(texts):
                doc, pairs, times = words.of(texts[x:y]).links()
                open_ = lookup.counts(pairs) < 0
                at = (x + doc[open_]).tolist()
                yield [ids.take(at), hashes.take(at), pairs[open_], times[open_], lookup.best[pairs[open_] >> _B_BITS]]

    # Rows of the same id and text have the same links; they are counted once here and joined to each.
    links = in_arrow(texts.select("doc_id", "text", "text_hash").where("text is not null"), unknown,
                     "doc_id long, text_hash long, pair long, times long, best long").distinct()
    links = links.join(rare, "pair")
    more = links.groupBy("doc_id", "text_hash").agg(
        F.sum(F.col("times") * F.col("n_docs")).alias("more_sum"),
        F.sum(F.when(F.col("n_docs") == F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long"))).alias("more_best"))
    more = materialize(more.withColumnsRenamed({"doc_id": "more_id", "text_hash": "more_hash"}), "rare-links")
    joined = found.join(more, F.col("doc_id").eqNullSafe(F.col("more_id")) & (F.col("text_hash") == F.col("more_hash")), "left")
    joined = joined.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0).cast("long")),
                                 "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0).cast("long"))})
    return joined.drop("more_id", "more_hash", "more_sum", "more_best")
