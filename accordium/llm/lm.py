"""LM scoring by online logistic context mixing.

A text is a sequence of lower-cased words and an end. Documents are dealt into groups of about GROUP bytes by their least
three-word hash, so that copies and texts with passages in common mostly meet; a group that copies have made too large is split, and rows that repeat both id and text are dealt to its parts.
Groups and what they learn depend on the documents alone, not on how their rows are partitioned, and grow in number with them;
the words of all training documents are counted in Spark and joined to the groups.

In a group a word is a path of bits: whether the group's training documents have it, then its place among those words, the
most frequent of the whole corpus first. Each bit is predicted by three contexts: the path so far with the counts of the whole
corpus, the word before, and the two words before, hashed with the path so far. Their logits are added with weights that a gate
chooses, by how well the contexts are known, and an adaptive map of (gate, probability) refines the sum; both are learned
online, batch after batch. A word that only other groups know costs its share of the corpus. A word that no training document
has is spelled: bits of its bytes and a blank, predicted by hashed contexts (the last two and three bytes and all bytes so far),
mixed and refined in the same way, whose counts are learned online from the words that occur once.

What a training document adds itself is left out while it is scored: its own occurrence of each word and of each context.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bytes_of, fold_of, freed, offsets, one_list, slices, slices_of, words_of, written

#: Bytes of text in a group, about; groups of more than twice that are split.
GROUP = 8_000_000
#: Split groups are broadcast up to so many (16 bytes each); beyond that Spark shuffles both sides.
BROADCAST_GROUPS = 1_000_000
#: Bits of a group's tables of word contexts, and of its tables of the last two and three bytes and of all bytes so far.
WORD_BITS = 21
BYTE_BITS = (18, 19, 19)
START = offsets([1 << b for b in BYTE_BITS])
ADD = np.float32(0.4)
STEPS = 33
#: Words of text whose bits are predicted together, before anything is learned from them.
BATCH = 4096
#: Bytes whose words are hashed together, where a word isn't longer.
HASHED = 250_000
RATE = 0.2
M = 0xD6E8FEB86659FD93
INVERSE = pow(M, -1, 1 << 64)
#: The first node of places; those before are of their lengths.
PLACES = 64


class Mixer:
    """Weights by gate for some logits, and the map that refines their sum; both are learned online."""

    def __init__(self, first: np.ndarray):
        self.weights = first.astype(np.float32)
        gates = len(first)
        middle = 1 / (1 + np.exp((STEPS // 2 - np.arange(STEPS)) * (16 / (STEPS - 1))))
        self.ones, self.all = np.tile(middle * 8, gates), np.full(gates * STEPS, 8.0)

    def predict(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        """Chances of a one; x holds a row for each context."""
        z = self.weights[:, 0].take(gate)
        z *= x[0]
        for k in range(1, len(x)):
            z += self.weights[:, k].take(gate) * x[k]
        np.clip(z, -18, 18, out=z)
        self.at = (np.clip(z, -8, 8) * np.float32((STEPS - 1) / 16) + np.float32(STEPS // 2 + 0.5)).astype(np.int64)
        self.at += gate * STEPS
        np.negative(z, out=z)
        np.exp(z, out=z)
        z += 1
        self.mixed = np.reciprocal(z, out=z)
        return np.float32(0.5) * (self.mixed + (self.ones / self.all).astype(np.float32).take(self.at))

    def learn(self, x: np.ndarray, gate: np.ndarray, bits: np.ndarray) -> None:
        """From the bits of the last prediction: a step by the gradient over the curvature, and counts of the map."""
        error, spread, gates = bits - self.mixed, self.mixed * (1 - self.mixed), len(self.weights)
        for k in range(len(x)):
            e, v = error, spread
            if k < len(x) - 1:  # the last is the bias
                e, v = error * x[k], spread * x[k]
                v *= x[k]
            self.weights[:, k] += RATE * np.bincount(gate, e, gates) / (np.bincount(gate, v, gates) + 10.0)
        self.at <<= 1
        self.at += bits > 0
        zeros, ones = np.bincount(self.at, minlength=2 * len(self.ones)).reshape(-1, 2).T
        self.ones += ones
        self.all += zeros + ones


def _cost(p: np.ndarray, bits: np.ndarray) -> np.ndarray:
    chance = 1 - bits
    chance -= p
    np.log2(np.abs(chance, out=chance), out=chance)
    return np.negative(chance, out=chance)


def _both(counts: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of zeros and ones of some slots; the two lie side by side and are fetched as one."""
    pair = counts.view(np.complex64).take(slot)
    return pair.real, pair.imag


def _logit(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    odds = n1 + ADD
    odds /= n0 + ADD
    return np.log(odds, out=odds)


def _level(total: np.ndarray) -> np.ndarray:
    """How well a context is known: 0 to 3."""
    out = (total > 0).view(np.int8) + (total > 2).view(np.int8)
    out += (total > 30).view(np.int8)
    return out.astype(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def byte_bits(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all bits of all bytes (8 rows) of words and their blanks: the slots of the contexts, the bits, and each byte's word."""
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    begin = offsets(size)[:-1]
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(data)) - begin[word]
    prev = [np.where(place >= k, np.concatenate([np.zeros(k, np.uint8), data[:-k]])[: len(data)], 0).astype(np.uint64) for k in (1, 2, 3)]
    running = np.cumsum(data.astype(np.uint64) * _powers(M, len(data)))
    before = np.concatenate([[np.uint64(0)], running[:-1]])
    prefix = (before - before[begin][word]) * _powers(INVERSE, len(data))[begin][word]
    two = prev[0] | prev[1] << np.uint64(8)
    node = (data[None, :].astype(np.uint64) | np.uint64(256)) >> (8 - np.arange(8, dtype=np.uint64))[:, None]
    contexts = (two, two | prev[2] << np.uint64(16), prefix ^ (place.astype(np.uint64) << np.uint64(40)))
    slots = np.empty((len(BYTE_BITS), 8, len(data)), np.int64)
    for k in range(len(BYTE_BITS)):
        h = (contexts[k] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        slot = np.add(h[None, :], node, out=slots[k].view(np.uint64))
        slot *= np.uint64(M)
        slot >>= np.uint64(64 - BYTE_BITS[k])
        slots[k] += START[k]
    return slots, ((data[None, :] >> (7 - np.arange(8, dtype=np.uint8))[:, None]) & 1).astype(np.int64), word


class Speller:
    """Costs of words that are spelled, and what is learned from them."""

    def __init__(self):
        self.counts = np.zeros(2 * int(START[-1]), np.float32)
        self.mixer = Mixer(np.tile([0.2, 0.4, 0.4, 0.0], (16, 1)))

    def bits(self, words: list[bytes], learn: bool) -> np.ndarray:
        """Bits of each word with its blank; all are predicted before any is learned from."""
        slots, bits, word = byte_bits(words)
        flat = bits.reshape(-1)
        x, gate, ones = np.ones((len(BYTE_BITS) + 1, len(flat)), np.float32), np.zeros(len(flat), np.int64), flat.astype(np.float32)
        for k in range(len(BYTE_BITS)):
            n0, n1 = _both(self.counts, slots[k].reshape(-1))
            x[k] = _logit(n0, n1)
            if k:  # the two longest contexts choose the weights
                gate += _level(n0 + n1) << 2 * (k - 1)
        cost = _cost(self.mixer.predict(x, gate), ones)
        if learn:
            self.mixer.learn(x, gate, ones)
            for k in range(len(BYTE_BITS)):
                np.add.at(self.counts, 2 * slots[k].reshape(-1) + flat, np.float32(1))
        return np.bincount(word, cost.reshape(bits.shape).sum(axis=0), len(words))

    def all(self, words: list[bytes], learn: bool) -> np.ndarray:
        out = [self.bits(words[c : min(b, c + 4096)], learn) for a, b in slices(words, 40_000) for c in range(a, b, 4096)]
        return np.concatenate(out) if out else np.zeros(0)


def _codes(weights: list[int]) -> list[tuple[list[int], list[int]]]:
    """Nodes and bits of each symbol in a Huffman tree: the rarer a symbol, the longer its path."""
    heap = [(w, i, [i]) for i, w in enumerate(weights)]
    heapify(heap)
    paths: list[tuple[list[int], list[int]]] = [([], []) for _ in weights]
    for node in range(len(weights) - 1):
        (v, i, zeros), (w, j, ones) = heappop(heap), heappop(heap)
        for bit, part in enumerate((zeros, ones)):
            for k in part:
                paths[k][0].insert(0, node)
                paths[k][1].insert(0, bit)
        heappush(heap, (v + w, min(i, j), zeros + ones))
    return paths


def _paths(n: int, codes: list[tuple[list[int], list[int]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes and bits of the paths of places 0 to n - 1, then of a word that only other groups have, then of one that none has.

    A place is coded by its length in bits, after `codes` of the lengths and of the two other kinds; then come the bits after
    the first.
    """
    value = np.arange(1, n + 1)
    length = np.floor(np.log2(value)).astype(np.int64) if n else np.zeros(0, np.int64)
    head = np.array([len(c[0]) for c in codes])
    kind = np.concatenate([length, [len(codes) - 2, len(codes) - 1]])
    size = head[kind] + np.concatenate([length, [0, 0]])
    begin = offsets(size)[:-1]
    nodes, bits = np.zeros(int(size.sum()), np.int32), np.zeros(int(size.sum()), np.int8)
    for k, (own_nodes, own_bits) in enumerate(codes):
        at = begin[kind == k]
        for j, (node, bit) in enumerate(zip(own_nodes, own_bits, strict=True)):
            nodes[at + j], bits[at + j] = node, bit
    for j in range(int(length.max(initial=0))):
        has = slice((2 << j) - 1, n)  # places of more than j bits after the first
        left, at = length[has] - j, begin[:n][has] + head[length[has]] + j
        nodes[at] = PLACES + (1 << length[has]) + (value[has] >> left)
        bits[at] = (value[has] >> (left - 1)) & 1
    return nodes, bits, begin, size


def _node_counts(corpus: np.ndarray, codes: list[tuple[list[int], list[int]]], kinds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """How often each node's bit is zero and one, from the places' counts. Places of a length are summed in pairs, up their tree;
    before them, lengths share kinds[0], the tokens of known words, in proportion to their counts."""
    depth, share = len(codes) - 2, kinds[0] / max(1, int(corpus.sum()))
    zeros, ones = (np.zeros(PLACES + (1 << depth)) for _ in range(2))
    weights = []
    for length in range(depth):
        width = 1 << length
        level = np.zeros(width)
        own = corpus[width - 1 : 2 * width - 1]
        level[: len(own)] = own
        while width > 1:
            width >>= 1
            at, pairs = PLACES + (1 << length) + width, level.reshape(-1, 2)
            zeros[at : at + width], ones[at : at + width] = pairs.T
            level = pairs.sum(axis=1)
        weights.append(level[0] * share)
    for weight, (nodes, bits) in zip([*weights, *kinds[1:]], codes, strict=True):
        for node, bit in zip(nodes, bits, strict=True):
            (ones if bit else zeros)[node] += weight
    return zeros, ones


def _grams(hashes: np.ndarray) -> np.ndarray:
    key = np.zeros(max(0, len(hashes) - 2), np.uint64)
    for i in range(3):
        key = (key ^ hashes[i : i + len(key)]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _repeated(pairs: np.ndarray, train: np.ndarray) -> np.ndarray:
    """Where other training tokens have the same pair as well. Pairs are sorted in parts that hold all of a pair's equals."""
    out = np.zeros(len(pairs), bool)
    part = (pairs * np.int64(0x61C8864680B583EB) >> np.int64(61)).astype(np.int8)
    for k in range(-4, 4):
        at = np.flatnonzero(part == k).astype(np.int32)
        _, same = np.unique(pairs.take(at), return_inverse=True)
        own = train.take(at)
        out[at] = np.bincount(same[own], minlength=len(at) + 1).take(same) > own
    return out


def group_bits(seq: np.ndarray, tokens: np.ndarray, held: np.ndarray, words: list[bytes], local: np.ndarray, corpus: np.ndarray, total: int) -> np.ndarray:
    """Bits of every token of a group, of those that are held out, and of the others as if they were. seq: numbers of words, document after document; tokens: how many a document has; local and
    corpus: a word's count in the training documents of the group and of the corpus; total: tokens of all training documents."""
    train = np.repeat(~held, tokens)  # such a token adds itself to the counts
    is_known, elsewhere = local.take(seq) > train, corpus.take(seq) > train
    order = np.lexsort((np.arange(len(words)), -corpus))
    order = order[local[order] > 0]
    place = np.zeros(len(words), np.int32)
    place[order] = np.arange(len(order))
    unknown, other = ~is_known & ~elsewhere, ~is_known & elsewhere
    symbol = place.take(seq)
    symbol[other], symbol[unknown] = len(order), len(order) + 1
    kinds = [int((train & k).sum()) for k in (is_known, other, unknown)]
    cost = np.zeros(len(seq))

    spelled, speller = np.zeros(len(words)), Speller()
    for chosen, learn in (((local == 1) & (corpus == 1), True), (corpus == 0, False)):
        which = np.flatnonzero(chosen)
        spelled[which] = speller.all([words[i] for i in which], learn)
    cost[unknown] = spelled[seq[unknown]]
    cost[other] = np.log2(np.maximum(total - train[other], 1)) - np.log2(corpus[seq[other]] - train[other])
    del is_known, elsewhere, unknown, other, place, spelled, speller

    # the two words before; an end stands before every document
    start, end = offsets(tokens)[:-1], seq[-1]
    before = np.concatenate([seq[-1:], seq[:-1]]).astype(np.int32)
    before[start] = end
    second = np.concatenate([before[:1], before[:-1]])
    second[start] = end

    def active(context: np.ndarray) -> np.ndarray:
        """Where other training tokens have the context as well."""
        return np.bincount(context[train], minlength=len(words)).take(context) > train

    pairs = second * np.int64(len(words))
    pairs += before
    actives = [active(before), _repeated(pairs, train)]
    del pairs

    lengths = np.floor(np.log2(np.arange(1, len(order) + 1))).astype(np.int64) if len(order) else np.zeros(0, np.int64)
    codes = _codes([*(np.bincount(lengths, corpus[order]).astype(np.int64) + 1).tolist(), kinds[1] + 1, kinds[2] + 1])
    del lengths
    nodes, bits, begin, size = _paths(len(order), codes)
    # the corpus at every node: logits with all counts, and with one less of a zero or a one
    zeros, ones = _node_counts(corpus[order], codes, kinds)
    whole = _logit(zeros, ones).astype(np.float32)
    less = np.stack([_logit(np.maximum(zeros - 1, 0), ones), _logit(zeros, np.maximum(ones - 1, 0))], axis=1).astype(np.float32).reshape(-1)

    def expanded(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For some tokens: the places of their bits in nodes and bits, and how many they have."""
        of = symbol.take(which)
        n = size.take(of)
        ends = np.cumsum(n)
        at = np.arange(int(ends[-1]))
        at += np.repeat(begin.take(of) - (ends - n), n)
        return at, n

    def slot(k: int, which: np.ndarray, n: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Slots of all bits of some tokens, of which each has n."""
        context = (before.take(which) + 1).astype(np.uint64)
        if k:
            context ^= (second.take(which) + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        context *= np.uint64((M, INVERSE)[k])
        h = np.repeat(context, n)
        h += node.view(np.uint64)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(M)
        h >>= np.uint64(64 - WORD_BITS)
        return h.view(np.int64)

    tables = [np.zeros(2 << WORD_BITS, np.float32) for _ in actives]
    for k, table in enumerate(tables):
        which = np.flatnonzero(train & actives[k])
        for a in range(0, len(which), BATCH):
            part = which[a : a + BATCH]
            at, n = expanded(part)
            pair = slot(k, part, n, nodes.take(at).astype(np.int64))
            pair <<= 1
            pair += bits.take(at)
            np.add.at(table, pair, np.float32(1))

    mixer = Mixer(np.tile([[0.9, 0.1, 0.1, 0.0], [0.7, 0.3, 0.1, 0.0], [0.4, 0.6, 0.2, 0.0], [0.2, 0.8, 0.3, 0.0]], (8, 1)))
    for chosen, learn in ((train, True), (~train, False)):
        which = np.flatnonzero(chosen)
        for a in range(0, len(which), BATCH):
            part = which[a : a + BATCH]
            at, n = expanded(part)
            node, one = nodes.take(at).astype(np.int64), bits.take(at)
            bit = one.astype(np.float32)
            x = np.zeros((4, len(at)), np.float32)
            x[0], x[3] = less.take(node * 2 + one) if learn else whole.take(node), 1
            gate = (node >= PLACES) * 16
            for k, table in enumerate(tables):
                has = actives[k].take(part)
                some = np.flatnonzero(np.repeat(has, n))
                n0, n1 = _both(table, slot(k, part[has], n[has], node.take(some)))
                if learn:  # without the token's own
                    mine = bit.take(some)
                    n1 -= mine
                    n0 -= 1 - mine
                x[k + 1, some] = _logit(n0, n1)
                n0 += n1
                gate[some] += _level(n0) * (1, 4)[k]
            spent = _cost(mixer.predict(x, gate), bit)
            if learn:
                mixer.learn(x, gate, bit)
            cost[part] += np.add.reduceat(spent, np.cumsum(n) - n)
    return cost


_LOWER, _BLANK = np.frombuffer(LOWER, np.uint8), np.isin(np.arange(256), [*range(9, 14), 32])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word (A-Z lower-cased, between ASCII blanks) of some texts without nulls, and how many words a text has."""
    _, edges, buffer = texts.buffers()
    edge = np.frombuffer(edges, np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buffer if buffer is not None else b"", np.uint8)[edge[0] : edge[-1]]
    edge -= edge[0]
    first = np.zeros(len(data) + 1, bool)  # of a text
    first[edge] = True
    solid = ~_BLANK.take(data)
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:-1]
    stops[:-1] &= ~solid[1:] | first[1:-1]
    begins, stops = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    out = np.empty(len(begins), np.uint64)
    a, powers, inverse = 0, *(_powers(base, HASHED) for base in (M, INVERSE))
    while a < len(begins):
        b = max(a + 1, int(np.searchsorted(stops, begins[a] + HASHED, side="right")))
        at = int(begins[a])
        n = int(stops[b - 1]) - at
        if n > len(powers):  # a long word
            powers, inverse = _powers(M, n), _powers(INVERSE, n)
        running = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER.take(data[at : at + n]) + np.uint64(1)) * powers[:n], out=running[1:])
        out[a:b] = (running.take(stops[a:b] - at) - running.take(begins[a:b] - at)) * inverse.take(begins[a:b] - at)
        a = b
    return out, np.diff(np.searchsorted(begins, edge))


def _grouped(groups: int, sizes: bool):
    """Each row with the number of its group; or, where only sizes are wanted, that and its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            keys = np.zeros(len(texts), np.uint64)
            for a, b in slices_of(texts):
                words, counts = word_hashes(pc.fill_null(texts.slice(a, b - a), ""))
                ends = np.cumsum(counts)
                grams = _grams(words)
                own = np.full(len(words), 0xFFFFFFFFFFFFFFFF, np.uint64)  # no gram starts at a text's last two words
                own[: len(grams)] = grams
                for back in (1, 2):
                    own[ends[counts >= back] - back] = 0xFFFFFFFFFFFFFFFF
                some = np.flatnonzero(counts)
                if len(some):
                    keys[a + some] = np.minimum.reduceat(own, (ends - counts)[some])
                    few = some[counts[some] < 3]
                    keys[a + few] = words[(ends - counts)[few]]
            group = pa.array(((keys * np.uint64(M)) >> np.uint64(20)).astype(np.int64) % groups)
            if sizes:
                yield pa.RecordBatch.from_arrays([group, pc.add(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64()), 1)], names=["group", "bytes"])
            else:
                yield pa.RecordBatch.from_arrays([*batch.columns, group], names=[*batch.schema.names, "group"])

    return run


def _groups(rows: DataFrame, kind: str) -> DataFrame:
    """rows (doc_id, text, fold, print) with `chunk`, the group that a document belongs to, and `copies`, how often it is there."""
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    groups = max(1, -(-int(total) // GROUP))
    sizes = rows.mapInArrow(_grouped(groups, True), "group long, bytes long").groupBy("group").agg(F.sum("bytes").alias("bytes"))
    split = written(sizes.where(F.col("bytes") > 2 * GROUP).select("group", F.ceil(F.col("bytes") / GROUP).alias("parts")), "split")
    dealt = rows.mapInArrow(_grouped(groups, False), f"doc_id {kind}, text string, fold long, print long, group long")
    many = split.count()
    if not many:
        return dealt.withColumnRenamed("group", "chunk").withColumn("copies", F.lit(1).cast("long"))
    dealt = dealt.join(F.broadcast(split) if many <= BROADCAST_GROUPS else split, "group", "left")
    fields = ["doc_id", "text", "fold", "print"]
    own = F.pmod(F.xxhash64("doc_id", "print"), "parts")
    chunk = lambda part: (F.coalesce(part, F.lit(0)) * groups + F.col("group")).alias("chunk")
    repeated = written(rows.groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated")
    if repeated.isEmpty():
        return dealt.select(*fields, chunk(own), F.lit(1).cast("long").alias("copies"))
    # rows that repeat both id and text: one of them goes to each part with the number of copies that fall to it
    twins = repeated.select(F.col("doc_id").alias("twin_id"), F.col("print").alias("twin"))
    same = F.col("doc_id").eqNullSafe(F.col("twin_id")) & F.col("print").eqNullSafe(F.col("twin")) & F.col("parts").isNotNull()
    single = dealt.join(twins, same, "left_anti").select(*fields, chunk(own), F.lit(1).cast("long").alias("copies"))
    once = dealt.join(twins, same, "left_semi").groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("text", "fold", "group", "parts")))
    share = once.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.least("n", "parts") - 1)))
    return single.union(share.select(*fields, chunk(F.pmod(own + F.col("k"), "parts")), F.floor((F.col("n") - F.col("k") - 1) / F.col("parts") + 1).alias("copies")))


def _chunk(kind: pa.DataType):
    """A row for a group: its words and their counts in its training documents, and its documents as numbers of words."""

    def run(docs: pa.Table) -> pa.Table:
        docs = docs.sort_by([("print", "ascending"), ("doc_id", "ascending")])
        copies = docs["copies"].to_numpy()
        if copies.max() > 1:
            docs = docs.take(np.repeat(np.arange(len(copies)), copies))
        number: dict[bytes, int] = {}
        seq: list[np.ndarray] = []
        tokens, size = [], []
        for batch in docs.select(["text"]).to_batches(max_chunksize=10_000):
            texts = batch.column(0)
            for a, b in slices_of(texts):
                names, of, counts = words_of(texts.slice(a, b - a))
                own = np.fromiter((number.setdefault(w, len(number)) for w in names), np.int32, len(names)).take(of)
                bytes_ = offsets(np.fromiter(map(len, names), np.int64, len(names)).take(of))
                ends = np.cumsum(counts)
                size.append(bytes_[ends] - bytes_[ends - counts] + counts)
                tokens.append(counts + 1)
                seq.append(np.insert(own, ends, number.setdefault(b"", len(number))))
        tokens, size = np.concatenate(tokens), np.concatenate(size)
        held = docs["fold"].to_numpy() == 2
        flat = np.concatenate(seq)
        train = np.bincount(flat[np.repeat(~held, tokens)], minlength=len(number))
        columns = {"chunk": docs["chunk"].slice(0, 1).combine_chunks(), "words": one_list(pa.array(list(number), pa.binary()).cast(pa.string())), "train": one_list(pa.array(train.astype(np.int32)))}
        columns |= {"ids": one_list(docs["doc_id"].combine_chunks().cast(kind)), "held": one_list(pa.array(held)), "tokens": one_list(pa.array(tokens)), "bytes": one_list(pa.array(size)), "seq": pa.array([flat.astype("<i4").tobytes()], pa.binary())}
        freed()
        return pa.table(columns)

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte; one row for each row of docs.

    docs needs doc_id and text; other columns are ignored, whatever their names. Texts are taken whole; a null text is an
    empty one, which is an end alone. Documents whose id has remainder 2 are held out of everything that is learned; a null
    doc_id has remainder 0. Rows that repeat a doc_id are documents of their own. Without training documents N and V are 0 and
    every word is spelled with even chances. bits_per_byte is over the words' bytes and blanks, 0 where there are none but the
    end. Scores don't depend on the rows' order or partitions. An empty table gives an empty result. Words are counted under
    a hash of 64 bits.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", fold_of("doc_id", 7).alias("fold"), F.xxhash64("text").alias("print"))
    fields = f"chunk long, words array<string>, train array<int>, ids array<{kind}>, held array<boolean>, tokens array<long>, bytes array<long>, seq binary"
    chunks = written(_groups(rows, kind).groupBy("chunk").applyInArrow(_chunk(to_arrow_type(docs.schema["doc_id"].dataType)), fields), "chunks")
    words = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "train")).alias("k", "w"))
    words = words.select("chunk", "k", F.xxhash64("w.words").alias("key"), F.col("w.train").alias("n"))
    # a frequent word has a row in every group: it is counted with partial sums, and its partition of the join can be split
    counted = written(words.groupBy("key").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("groups")), "counts")
    total = counted.agg(F.coalesce(F.sum("all"), F.lit(0)).alias("n"), F.count(F.when(F.col("all") > 0, 1)).alias("v")).first()
    # a group's own count is the corpus's where no other has the word
    placed = words.join(counted.where("groups > 1").select("key", "all"), "key").where("n <> all").select(F.col("chunk").alias("of"), "k", F.col("all").alias("n"))
    train_tokens, floor = int(total.n), float(np.log10(total.n + total.v + 1))

    def finish(docs_of: pa.Table, words_of: pa.Table) -> pa.Table:
        freed()  # a worker is kept for other tasks
        row = {c: docs_of[c].combine_chunks()[0].values for c in ("words", "train", "ids", "held", "tokens", "bytes")}
        seq = np.frombuffer(docs_of["seq"].combine_chunks()[0].as_buffer(), "<i4")
        local = row["train"].to_numpy().astype(np.int64)
        n = local.copy()
        n[words_of["k"].to_numpy()] = words_of["n"].to_numpy()
        tokens, held = row["tokens"].to_numpy(), row["held"].to_numpy(zero_copy_only=False)
        bits = group_bits(seq, tokens, held, bytes_of(row["words"]), local, n, train_tokens)
        freed()
        begin = offsets(tokens)[:-1]
        known, base, spent = (np.add.reduceat(v, begin) for v in ((n > 0)[seq].astype(np.int64), (np.log10(n + 1) - floor)[seq], bits))
        size = row["bytes"].to_numpy()
        return pa.table({"doc_id": row["ids"], "held_out": row["held"], "n_tokens": row["tokens"], "n_known": known, "train_tokens": np.full(len(size), train_tokens), "base_score": base, "score": -spent * np.log10(2), "bits_per_byte": np.where(size > 0, spent / np.maximum(size, 1), 0.0)})

    documents = chunks.select("chunk", "words", "train", "ids", "held", "tokens", "bytes", "seq")
    return documents.groupBy("chunk").cogroup(placed.groupBy("of")).applyInArrow(finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
