"""Token-id files: an adaptive context-mixing range coder in checked blocks.

Documents are sorted by id in range partitions. Each task encodes its texts,
ends every document with an end id, cuts the stream of ids into blocks of
``BLOCK`` and packs up to ``LANES`` blocks a row. Blocks are reset
independently and carry a CRC-32 of their ids.

A block's coder predicts each id from the last two ids (order 2) and from the
last one (order 1), by what followed them before in the block. One event an id
says which order foresaw it, if any. The odds of order 2 mix its confidence,
that of order 1 and whether both agree, and the block's own hit rate, in the
logistic domain, learning from every id; those of order 1 after a miss mix its
confidence and hit rate alike. An id that neither foresees is coded by its
order-0 frequency among the row's ids, which the row carries. Events and
unforeseen ids drive a range coder with carry each; the two parts follow one
another in the block's payload. All arithmetic is on integers, so files read
alike on every machine.

The blocks of a row are coded together, as lanes of array operations.

File format: Parquet, one row per up to ``LANES`` blocks, see ``FIELDS``. Rows
are in order by ``part`` and ``row``; parts are in ascending order of ids.

Defined results: null and empty texts have the end id alone; repeated rows
are documents of their own; equal and null ids are in some order, the same in
the file and the index; an empty table gives no rows; other columns are not
used.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meridian.llm.common import batch_rows, ship, staged, tidy, utf8

BLOCK = 2048
LANES = 4096
PAD = 16                        # lanes more in a row of memory, so that columns don't share cache sets
END_ID = 2
WORD_CACHE = 800_000
LINES = 200                     # words encoded in one call
STRETCH = 8 << 20               # bytes of texts encoded together
STEPS = 64                      # steps whose shares are found together
SLOTS_1, SLOTS_2 = 2048, 4096   # of a block's order-1 and order-2 predictions
CONFIDENT = 15
RATE = 6                        # learning: a shift of the error

_U = np.uint64
_WORD, _HALF = _U(24), _U((1 << 24) - 1)
_FULL = _U((1 << 48) - 1)
_LEAST = _U(1 << 24)
_SHARE, _SHARED = _U(16), np.uint32(65534)
# probabilities (of 65536) for log odds in steps of 1/256
_SQUASH = np.clip(np.rint(65536 / (1 + np.exp(-(np.arange(4096) - 2048) / 256.0))), 32, 65504).astype(np.uint32)

# a prediction's gain or loss by confidence, then by confidence where it holds;
# or that the id that came takes its place
_GONE = np.int32(-16)
_CHANGE = np.array([_GONE, _GONE, *(-(c + 1 >> 1) for c in range(2, 16)), *([1] * 15), 0], np.int32)

# how a tokenizer cuts texts whose words may be cut here: lower case and
# composed characters are all that changes before the cuts
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# words of visible ASCII, of Latin-1 letters (composed, with one lower case) and
# of its marks; and their pieces in lower case, with the line ends between words
_CHARS = "!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u00a1\u00ab\u00bb\u00bf"
_COMMON, _COMMON_LINES = re.compile(f"[{_CHARS}]+").fullmatch, re.compile(f"[{_CHARS}\n]+").fullmatch
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\na-z0-9\u00df-\u00f6\u00f8-\u00ff]+|\n").findall

_HELD = "_meridian_token_words"  # where a worker keeps its words

FIELDS = ("part int, row long, first_id long, first_doc long, continues boolean, n_ids long, "
          "frequencies binary, lengths array<int>, checks array<long>, payloads array<binary>, counts array<long>")


class _Mixer:
    """The adaptive state of ``n`` blocks. Pairs of rows are order 2 and order 1."""

    def __init__(self, n: int):
        lane = np.arange(n)
        # predictions: 16 x id + confidence
        self.table = np.zeros(n * (SLOTS_2 + SLOTS_1), np.int32)
        self.lane = np.stack([lane * SLOTS_2, n * SLOTS_2 + lane * SLOTS_1])
        # by the confidence of either order; by order-1 confidence and agreement
        by_confidence = np.arange(-3, 5, 0.5) * 2048
        self.odds = np.concatenate([np.tile(by_confidence, 2 * n), np.zeros(32 * n)]).astype(np.int32)
        self.odds_lane = np.stack([lane * 16, (n + lane) * 16])
        self.bias = np.zeros((2, n), np.int32)

    def slots(self, last1: np.ndarray, last2: np.ndarray) -> np.ndarray:
        """Where the predictions after these ids lie, ``(..., 2, k)``."""
        at = np.empty((*last1.shape[:-1], 2, last1.shape[-1]), np.uint32)
        two, one = at[..., 0, :], at[..., 1, :]
        np.multiply(last1.view(np.uint32), np.uint32(40503), out=one)
        np.multiply(last2.view(np.uint32), np.uint32(30011), out=two)
        two += one
        two >>= np.uint32(4)
        one >>= np.uint32(5)
        two &= np.uint32(SLOTS_2 - 1)
        one &= np.uint32(SLOTS_1 - 1)
        return np.add(at, self.lane[:, :at.shape[-1]], dtype=np.int64)

    def look(self, at: np.ndarray) -> None:
        """Predictions, and their chances (of 65536), of the first lanes."""
        k = at.shape[1]
        self.at, self.e = at, self.table.take(at)
        self.p, self.c = self.e >> 4, self.e & 15
        self.agree = self.p[0] == self.p[1]
        self.x = np.empty((3, k), np.int64)
        np.add(self.odds_lane[:, :k], self.c, out=self.x[:2])
        np.add(self.x[1], self.x[1], out=self.x[2])
        self.x[2] += self.agree
        self.o = self.odds.take(self.x)
        sums = self.o[:2] + self.bias[:, :k]
        sums[0] += self.o[2]
        sums >>= 4
        sums += 2048
        self.chance = _SQUASH.take(sums, mode="clip")

    def follow(self, ids: np.ndarray, hit: np.ndarray) -> None:
        """Take the ids that came. Order 1 learns its odds where it was asked.
        A prediction that holds gains confidence, one that fails loses half,
        and at the end its place."""
        k = len(ids)
        held = hit.astype(np.int32)
        err = held << 16
        err -= self.chance.view(np.int32)
        err >>= RATE
        err[1] *= ~(hit[0] | self.agree)
        self.o[:2] += err
        self.o[2] += err[0]
        self.odds[self.x.reshape(-1)] = self.o.reshape(-1)
        err >>= 2
        self.bias[:, :k] += err
        held <<= 4
        self.c += held
        change = _CHANGE.take(self.c, mode="clip")
        self.e += change
        fresh = ids * np.int32(16) + np.int32(1) - self.e
        fresh *= change == _GONE
        self.e += fresh
        self.table[self.at.reshape(-1)] = self.e.reshape(-1)


def _shares(chance2: np.ndarray, chance1: np.ndarray, agree: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of 65536 of the id that order 2 foresees, and of both ids; what
    is left is for an id that neither foresees."""
    share1 = (_SHARED - chance2) * chance1
    share1 >>= np.uint32(16)
    share1 += np.uint32(1)
    share1 *= ~agree
    return chance2, chance2 + share1


def frequencies(blocks: list[np.ndarray]) -> np.ndarray:
    """Order-0 shares of 65536 for each id up to the greatest; at least one for
    an id that occurs."""
    count = np.zeros(max(int(b.max()) for b in blocks) + 1, np.int64)
    for at in range(0, len(blocks), STEPS):
        count += np.bincount(np.concatenate(blocks[at:at + STEPS]), minlength=len(count))
    used = count > 0
    room = 65536 - int(used.sum())
    share = np.where(used, 1 + (count * room) // max(1, count.sum()), 0)
    share[int(np.argmax(share))] += 65536 - int(share.sum())
    return share.astype(np.uint32)


class _Encoder:
    """Range coders of ``n`` lanes. Words of all lanes lie side by side, and
    hold their carry until the end."""

    def __init__(self, n: int, steps: int):
        self.n, self.low, self.size = n, np.zeros(n, _U), np.full(n, _FULL)
        self.out, self.at = np.zeros((steps + 3) * n, np.uint32), np.arange(n)
        self.unit, self.thin = np.empty(n, _U), np.empty(n, bool)

    def put(self, start: np.ndarray, share: np.ndarray) -> None:
        """One event of each of the first lanes."""
        k = len(start)
        low, size, unit = self.low[:k], self.size[:k], self.unit[:k]
        np.right_shift(size, _SHARE, out=unit)
        np.multiply(unit, share, out=size)
        unit *= start
        low += unit
        thin = np.less(size, _LEAST, out=self.thin[:k]).nonzero()[0]
        if len(thin):
            part, at = low.take(thin), self.at.take(thin)
            self.out[at] = part >> _WORD
            at += self.n
            self.at[thin] = at
            part &= _HALF
            part <<= _WORD
            low[thin] = part
            size[thin] = size.take(thin) << _WORD

    def finish(self) -> list[bytes]:
        """The words of each lane."""
        for word in (self.low >> _WORD, self.low & _HALF):
            self.out[self.at] = word
            self.at += self.n
        used = self.at // self.n
        out = self.out.reshape(-1, self.n)[:int(used.max())]
        for t in range(len(out) - 1, 0, -1):
            out[t - 1] += out[t] >> np.uint32(24)
        words = np.ascontiguousarray(out.T, "<u4").view(np.uint8).reshape(self.n, -1, 4)
        return [words[j, :m, :3].tobytes() for j, m in enumerate(used.tolist())]


class _Decoder:
    """Range coders of the lanes with these words."""

    def __init__(self, words: list[bytes]):
        self.n, steps = len(words), max(len(w) for w in words) // 3 + 4
        held = np.zeros((self.n, steps, 4), np.uint8)
        for j, w in enumerate(words):
            held[j, :len(w) // 3, :3] = np.frombuffer(w, np.uint8).reshape(-1, 3)
        held = np.ascontiguousarray(held.view("<u4")[:, :, 0].T)
        self.code = held[0].astype(_U) << _WORD | held[1]
        self.size, self.words, self.at = np.full(self.n, _FULL), held.reshape(-1), np.arange(self.n) + 2 * self.n

    def take(self, below: np.ndarray, size: np.ndarray) -> None:
        """One event of each of the first lanes: what lies below, and its size."""
        code = self.code[:len(size)]
        code -= below
        self.size[:len(size)] = size
        thin = (size < _LEAST).nonzero()[0]
        if len(thin):
            at = self.at.take(thin)
            part = code.take(thin)
            part <<= _WORD
            part |= self.words.take(at)
            code[thin] = part
            at += self.n
            self.at[thin] = at
            self.size[thin] = size.take(thin) << _WORD


def _active(counts: np.ndarray) -> list[int]:
    """How many lanes still go on at each step; ``counts`` don't rise."""
    return np.searchsorted(-counts, -np.arange(int(counts[0]) if len(counts) else 0)).tolist()


def encode_blocks(blocks: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """Order-0 shares, and the payload of each block; no block is longer than
    the one before. A payload has two range-coded parts, the events and the
    ids that no order foresaw, after the words of the one and the number of
    the other."""
    share = frequencies(blocks)
    start = np.cumsum(share) - share
    n, longest = len(blocks), len(blocks[0])
    ids = np.zeros((longest + 2, n + PAD), np.int32)[:, :n]  # after two zeros
    length = np.array([len(b) for b in blocks])
    for j, b in enumerate(blocks):
        ids[2:len(b) + 2, j] = b
    active, mix, events = _active(length), _Mixer(n), _Encoder(n, longest)
    missed = np.zeros((longest, n), bool)
    for t in range(0, longest, STEPS):
        m = min(STEPS, longest - t)
        at = mix.slots(ids[t + 1:t + 1 + m], ids[t:t + m])
        chance, hits, agree = np.ones((2, m, n), np.uint32), np.ones((2, m, n), bool), np.zeros((m, n), bool)
        for i in range(m):
            k = active[t + i]
            mix.look(at[i, :, :k])
            x = ids[t + i + 2, :k]
            hit = mix.p == x
            chance[:, i, :k], hits[:, i, :k], agree[i, :k] = mix.chance, hit, mix.agree
            mix.follow(x, hit)
        two, both = _shares(chance[0], chance[1], agree)
        miss = missed[t:t + m] = ~(hits[0] | hits[1])
        first = np.where(hits[0], np.uint32(0), np.where(miss, both, two)).astype(_U)
        wide = np.where(hits[0], two, np.where(miss, np.uint32(65536) - both, both - two)).astype(_U)
        for i in range(m):
            k = active[t + i]
            events.put(first[i, :k], wide[i, :k])
    heads = events.finish()
    del mix, ids, events
    # lanes by falling number of ids missed
    missed = np.ascontiguousarray(missed.T)
    gone = [b[m[:len(b)]] for b, m in zip(blocks, missed)]
    counts = np.array([len(g) for g in gone])
    order = np.argsort(-counts, kind="stable")
    counts = counts[order]
    lost = np.zeros((n, int(counts[0])), np.int32)
    for i, j in enumerate(order.tolist()):
        lost[i, :len(gone[j])] = gone[j]
    del gone
    lost, rest = np.ascontiguousarray(lost.T), _Encoder(n, lost.shape[1])
    start, wide = start.astype(_U), share.astype(_U)
    for x, k in zip(lost, _active(counts)):
        rest.put(start.take(x[:k]), wide.take(x[:k]))
    tails = dict(zip(order.tolist(), zip(counts.tolist(), rest.finish())))
    out = []
    for j, head in enumerate(heads):
        m, tail = tails[j]
        out.append(np.array([len(head) // 3, m], "<u2").tobytes() + head + tail)
    return share, out


def _decode_missed(share: np.ndarray, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids that no order foresaw, one of each lane after the other, and
    where each lane's begin."""
    order = np.argsort(-counts, kind="stable")
    counts = counts[order]
    owner = np.repeat(np.arange(len(share), dtype=np.int32), share)
    start, wide = (np.cumsum(share.astype(np.int64)) - share).astype(_U), share.astype(_U)
    coder, out = _Decoder([words[j] for j in order]), np.zeros((int(counts[0]) + 1, len(words)), np.int32)
    for j, k in enumerate(_active(counts)):
        unit = coder.size[:k] >> _SHARE
        x = owner.take((coder.code[:k] // unit).view(np.int64), mode="clip").astype(np.int64)
        coder.take(unit * start.take(x), unit * wide.take(x))
        out[j, :k] = x
    begin = np.empty(len(words), np.int64)
    begin[order] = np.arange(len(words))
    return out.reshape(-1), begin


def decode_blocks(share: np.ndarray, payloads: list[bytes], lengths: list[int]) -> np.ndarray:
    """The ids of all blocks, one after the other."""
    if not payloads:
        return np.zeros(0, np.int32)
    n, longest = len(payloads), max(lengths)
    heads = np.array([np.frombuffer(p, "<u2", 2) for p in payloads]).astype(np.int64)
    ends = (4 + 3 * heads[:, 0]).tolist()
    lost, next_lost = _decode_missed(share, [p[end:] for p, end in zip(payloads, ends)], heads[:, 1])
    coder, mix = _Decoder([p[4:end] for p, end in zip(payloads, ends)]), _Mixer(n)
    out = np.zeros((longest + 2, n + PAD), np.int32)[:, :n]  # after two zeros
    for t, k in enumerate(_active(np.array(lengths))):
        mix.look(mix.slots(out[t + 1, :k], out[t, :k]))
        two, both = _shares(mix.chance[0], mix.chance[1], mix.agree)
        unit = coder.size[:k] >> _SHARE
        at = coder.code[:k]
        two, both = unit * two, unit * both
        hit, miss = at < two, at >= both
        unit <<= _SHARE
        unit -= both
        both -= two
        # what lies below, and the size: of order 2, of order 1, of neither
        coder.take(two * ~hit + both * miss, np.where(hit, two, np.where(miss, unit, both)))
        x = np.where(hit, mix.p[0], mix.p[1])
        who = miss.nonzero()[0]
        here = next_lost.take(who)
        x[who] = lost.take(here, mode="clip")
        here += n
        next_lost[who] = here
        out[t + 2, :k] = x
        mix.follow(x, mix.p == x)
    del mix, coder, lost
    ids = np.ascontiguousarray(out[2:].T)
    return np.concatenate([ids[j, :m] for j, m in enumerate(lengths)])


class _Pool:
    """Strings numbered as they come, with the ids of each. ``encode`` gives
    of an array of strings how many ids each has, and the ids."""

    def __init__(self, encode):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.pool, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, strings: pa.Array) -> np.ndarray:
        coded = strings.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.known)
        new = coded.dictionary.filter(at.is_null())
        at = at.fill_null(-1).to_numpy()
        if len(new):
            at = np.where(at < 0, len(self.known) - 1 + np.cumsum(at < 0), at)
            size, got = self.encode(new)
            self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.pool = np.concatenate([self.pool, got])
            self.known = pa.concat_arrays([self.known, new])
        return at[coded.indices.to_numpy()]

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the numbered strings, one after the other."""
        k = self.size[numbers]
        ends = np.cumsum(k)
        if not len(k) or not ends[-1]:
            return np.zeros(0, np.int32)
        kind = np.int32 if max(len(self.pool), ends[-1]) < 1 << 31 else np.int64
        at = np.repeat((self.start[numbers] - (ends - k)).astype(kind), k)
        at += np.arange(len(at), dtype=kind)
        return self.pool.take(at)


def _joined(words: pa.Array) -> str:
    """One word a line."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()


class _WordIds:
    """The ids of white-space separated words, each encoded once: the
    tokenizer never joins characters across white space. Words of common
    characters are cut where this tokenizer cuts them and each piece is
    encoded once, whatever stands around it and in whichever case."""

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(tokenizer_json)
        self.added = [t["content"] for t in spec["added_tokens"]]
        suffix = spec["model"].get("end_of_word_suffix")
        self.cuts = (spec["normalizer"], spec["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER) and bool(suffix)
        if self.cuts:
            # the same model without the steps that cut a text into pieces
            self.piece_tok = Tokenizer(self.tok.model)
            self.piece_tok.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for piece, i in vocab.items() if piece.endswith(suffix)]] = True
        self.words, self.pieces = _Pool(self.encode), _Pool(self.encode_pieces)

    def encode_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids. Words are encoded many at
        a time, one a line; an id belongs to the line that it starts in."""
        sizes, out = [], []
        for at in range(0, len(words), 64 * LINES):
            parts = [words[i:i + LINES] for i in range(at, min(at + 64 * LINES, len(words)), LINES)]
            for part, e in zip(parts, self.tok.encode_batch(["\n".join(p) for p in parts], add_special_tokens=False)):
                length = np.array([len(w) + 1 for w in part])
                first = np.array([a for a, _ in e.offsets], np.int64)
                line = np.searchsorted(np.cumsum(length) - length, first, side="right") - 1
                if len(line) and (np.diff(line) < 0).any():
                    raise RuntimeError("ids out of the order of their words")
                sizes.append(np.bincount(line, minlength=len(part)))
                out.append(np.array(e.ids, np.int32))
        return np.concatenate(sizes).astype(np.int64), np.concatenate(out)

    def encode_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces; the last id of a piece ends it."""
        starts = [*range(0, len(pieces), LINES), len(pieces)]
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pieces), " ").to_pylist()
        got = [np.array(self.piece_tok.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int32) for line in lines]
        ids, sizes = np.concatenate(got), np.array([len(g) for g in got])
        ends = np.flatnonzero(self.ends[ids])
        if len(ends) != len(pieces) or (ends[np.array(starts[1:]) - 1] != np.cumsum(sizes) - 1).any():
            raise RuntimeError("ids do not end with their pieces")
        return np.diff(ends, prepend=-1), ids

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for words, in pieces or as whole lines."""
        joined = _joined(words)
        if self.cuts and _COMMON_LINES(joined) and not any(t in joined for t in self.added):
            return self.encode_cut(joined, len(words))
        names = joined.split("\n")
        cut = np.array([bool(self.cuts and _COMMON(w) and not any(t in w for t in self.added)) for w in names])
        if not cut.any():
            return self.encode_lines(names)
        size = np.zeros(len(names), np.int64)
        size[cut], inside = self.encode_cut(_joined(words.filter(pa.array(cut))), int(cut.sum()))
        size[~cut], outside = self.encode_lines([w for w, c in zip(names, cut.tolist()) if not c])
        owner = np.repeat(cut, size)
        out = np.empty(len(owner), np.int32)
        out[owner], out[~owner] = inside, outside
        return size, out

    def encode_cut(self, lines: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for ``n`` common words, one a line."""
        found = pa.array(_PIECES(lines.lower()), pa.string())
        last = pc.equal(found, "\n")
        numbers = self.pieces.numbers(found.filter(pc.invert(last)))
        last = last.to_numpy(zero_copy_only=False)
        return np.bincount(np.cumsum(last)[~last], self.pieces.size[numbers], n).astype(np.int64), self.pieces.ids(numbers)

    def ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text has with the end id, and the ids."""
        for pool in (self.words, self.pieces):
            if len(pool.known) > WORD_CACHE:
                pool.clear()
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()))
        words, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        filled = pc.binary_length(words).to_numpy() > 0  # white space at either end leaves empty words
        ends = np.concatenate([[0], np.cumsum(filled)])[ends]
        numbers = self.words.numbers(words.filter(pa.array(filled)))
        after = np.concatenate([[0], np.cumsum(self.words.size[numbers])])[ends]
        return np.diff(after) + 1, np.insert(self.words.ids(numbers), after[1:], np.int32(end_id))


def _held_words(tokenizer_json: str) -> _WordIds:
    """One for each Python worker: its later tasks know the words already."""
    held = vars(sys.modules.setdefault(_HELD, types.ModuleType(_HELD)))
    key = f"words {zlib.crc32(tokenizer_json.encode('utf-8'))} {len(tokenizer_json)}"
    if key not in held:
        held[key] = _WordIds(tokenizer_json)
    return held[key]


def _stretches(batches):
    """Batches cut and joined to texts of up to ``STRETCH`` bytes, or one text."""
    held, size = [], 0
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("_utf8")).to_numpy(), dtype=np.int64)])
        at = 0
        while at < len(ends) - 1:
            to = int(np.searchsorted(ends, STRETCH - size + ends[at], side="right")) - 1
            if to <= at and held:
                yield pa.concat_batches(held)
                held, size = [], 0
                continue
            to = max(to, at + 1)
            held.append(batch.slice(at, to - at))
            size += int(ends[to] - ends[at])
            at = to
    if held:
        yield pa.concat_batches(held)


def _pack_row(part: int, row: int, first_id: int, first_doc: int, continues: bool, ids: np.ndarray,
              counts: list[int], doc_ids: list, id_type) -> pa.RecordBatch:
    blocks = [ids[i:i + BLOCK] for i in range(0, len(ids), BLOCK)]
    share, payloads = encode_blocks(blocks)
    cols = [(part, pa.int32()), (row, pa.int64()), (first_id, pa.int64()), (first_doc, pa.int64()), (continues, pa.bool_()),
            (len(ids), pa.int64()), (zlib.compress(share.astype("<u4").tobytes()), pa.binary()),
            ([len(b) for b in blocks], pa.list_(pa.int32())), ([zlib.crc32(b.astype("<u4").tobytes()) for b in blocks], pa.list_(pa.int64())),
            (payloads, pa.list_(pa.binary())), (counts, pa.list_(pa.int64())), (doc_ids, pa.list_(id_type))]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in cols], names=[f.split()[0] for f in FIELDS.split(", ")] + ["doc_ids"])


def _write_batches(tokenizer_json: str, end_id: int):
    """Rows of the file from sorted documents. What is held: the ids of one row
    and one document."""
    def run(batches):
        words, part = _held_words(tokenizer_json), TaskContext.get().partitionId()
        full = BLOCK * LANES
        row = first_id = first_doc = held = 0
        ids, counts, docs, continues, id_type = [], [], [], False, None

        def send(last_goes_on: bool):
            nonlocal row, first_id, first_doc, held, ids, counts, docs, continues
            whole = np.concatenate(ids)
            ids = []
            out = _pack_row(part, row, first_id, first_doc, continues, whole, counts, docs, id_type)
            row, first_id = row + 1, first_id + held
            first_doc += len(docs) - last_goes_on
            ids, counts, docs, continues, held = [], [], [], last_goes_on, 0
            return out

        for batch in _stretches(batches):
            id_type = batch.column("_id").type
            size, flat = words.ids(batch.column("_utf8"), end_id)
            end = np.cumsum(size).tolist()
            for name, a, b in zip(batch.column("_id").to_pylist(), [0, *end], end):
                got = flat[a:b]
                while len(got):
                    take = got[:full - held]
                    got = got[len(take):]
                    ids.append(take)
                    counts.append(len(take))
                    docs.append(name)
                    held += len(take)
                    if held == full:
                        yield send(len(got) > 0)
        if held:
            yield send(False)
    return run


def write(docs: DataFrame, path: str, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> None:
    """Encode every text of ``docs`` into a token-id file at ``path``."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).alias("_id"), utf8(text).alias("_utf8"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([*T._parse_datatype_string(FIELDS).fields, T.StructField("doc_ids", T.ArrayType(src.schema["_id"].dataType))])
    with batch_rows(spark, 1000):
        (src.repartitionByRange(n, "_id").sortWithinPartitions("_id").mapInArrow(tidy(_write_batches(spec, end_id)), schema)
         .write.option("compression", "none").option("parquet.block.size", 32 << 20).parquet(path))


def _read_batches(batches):
    """Fragments of documents: a row's part of each of them, with its CRC-32."""
    for batch in batches:
        for row in batch.to_pylist():
            share = np.frombuffer(zlib.decompress(row["frequencies"]), "<u4")
            ids = decode_blocks(share, row["payloads"], row["lengths"]).astype("<u4")
            at = 0
            for m, check in zip(row["lengths"], row["checks"]):
                if zlib.crc32(ids[at:at + m]) != check:
                    raise ValueError(f"a block of part {row['part']}, row {row['row']} is damaged")
                at += m
            ends = np.cumsum(row["counts"])
            starts = ends - np.array(row["counts"])
            crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * n, pa.int32()), pa.array(np.arange(n) + row["first_doc"]), pa.array([row["row"]] * n, pa.int64()),
                 pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type), pa.array(starts + row["first_id"], pa.int64()),
                 pa.array(row["counts"], pa.int64()), pa.array(crcs, pa.int64())],
                names=["part", "doc", "row", "doc_id", "first_id", "n", "crc"])


def _join_crc(batches):
    """The CRC-32 of a document from those of its fragments: that of zeros in a
    fragment's place, which the earlier ones shift, and its own."""
    for batch in batches:
        out = []
        for pieces in batch.column("pieces").to_pylist():
            total = 0
            for p in pieces:
                zeros = bytes(4 * p["n"]) if total else b""
                total = (zlib.crc32(zeros, total) ^ zlib.crc32(zeros) if total else zlib.crc32(bytes(4 * p["n"]), 0) ^ zlib.crc32(bytes(4 * p["n"]))) ^ p["crc"]
            out.append(total)
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names if n != "pieces"), pa.array(out, pa.int64())],
                                         names=[*(n for n in batch.schema.names if n != "pieces"), "ids_crc32"])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read a file back, checking all blocks. Per document: ``doc_id``,
    ``start``, ``n_tokens``, ``ids_crc32``."""
    file = spark.read.parquet(path)
    sizes = sorted((r["part"], r["n"]) for r in file.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    before = spark.createDataFrame([(p, sum(n for _, n in sizes[:i])) for i, (p, _) in enumerate(sizes)], "part int, before long")
    id_type = file.schema["doc_ids"].dataType.elementType
    schema = T.StructType([*T._parse_datatype_string("part int, doc long, row long").fields, T.StructField("doc_id", id_type),
                           *T._parse_datatype_string("first_id long, n long, crc long").fields])
    with batch_rows(spark, 1):
        pieces = staged(file.mapInArrow(tidy(_read_batches), schema), "pieces")
    whole = pieces.groupBy("part", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("first_id").alias("first_id"), F.sum("n").alias("n_tokens"),
        F.transform(F.sort_array(F.collect_list(F.struct("row", "n", "crc"))), lambda p: F.struct(p["n"].alias("n"), p["crc"].alias("crc"))).alias("pieces"))
    placed = whole.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("first_id")).alias("start"), "n_tokens", "pieces")
    out = T.StructType([*[f for f in placed.schema.fields if f.name != "pieces"], T.StructField("ids_crc32", T.LongType())])
    return placed.mapInArrow(_join_crc, out)


ship(__name__)
