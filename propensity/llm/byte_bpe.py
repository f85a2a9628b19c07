"""Byte-level BPE by a rank queue: encode texts to ids and ids back to bytes.

Pre-tokens are linked lists of positions. Every adjacent pair that forms a token waits in the
bucket of its merge rank; a bitmap of three levels marks the buckets in use, so the next rank
is found by three find-first-set steps. Within a bucket the leftmost position of a pre-token
goes first. A merge changes the pairs beside it; entries that no longer describe the pair at
their position are skipped when they come up.

``merge`` runs the queue over one pre-token: n bytes cost O(n) queue steps, so a pre-token of a
million letters is no special case. ``merge_many`` runs it over many short pre-tokens laid end
to end: pre-tokens never touch each other, so all that wait in a bucket merge in one numpy step.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache
from heapq import heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from propensity.llm.texts import map_batches, pieces, strings

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LONG = 200          # bytes; longer pre-tokens go through the queue one by one
KNOWN = 500_000     # chunks of text whose ids a worker remembers between batches
PIECE = 4_000_000        # characters of texts that are encoded together


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank; a line of the file holds both."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets by rank under a bitmap of three levels; 64 buckets or words below each bit."""

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.low = [0] * words
        self.middle = [0] * ((words >> 6) + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def open(self, rank: int, bucket: list) -> None:
        self.buckets[rank] = bucket
        word = rank >> 6
        if not self.low[word]:
            self.middle[word >> 6] |= 1 << (word & 63)
            self.top |= 1 << (word >> 6)
        self.low[word] |= 1 << (rank & 63)

    def first(self) -> int:
        """The lowest rank in use, or -1."""
        if not self.top:
            return -1
        word = (self.top & -self.top).bit_length() - 1
        bits = self.middle[word]
        word = (word << 6) + (bits & -bits).bit_length() - 1
        bits = self.low[word]
        return (word << 6) + (bits & -bits).bit_length() - 1

    def close(self, rank: int) -> None:
        del self.buckets[rank]
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length), one run after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


class Codec:
    """Encoder and decoder for one rank file; texts are split by ``PATTERN`` beforehand."""

    def __init__(self, ranks: dict[bytes, int], known: int = KNOWN):
        self.ranks = ranks
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.runs = regex.compile(r"[ \n](?:\s|\Z)").search
        self.queue = RankQueue(max(ranks.values(), default=0))
        size = max(ranks.values(), default=0) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_length = np.array([len(t) for t in tokens], np.int64)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        # Every way to put a token together from two others: key left << 32 | right, sorted.
        pairs = [(ranks[t[:i]] << 32 | ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs.sort()
        self.pair_key = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_rank = np.array([r for _, r in pairs] or [-1], np.int64)
        self.known = known
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.id_start, self.id_length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        get, queue, buckets = self.ranks.get, self.queue, self.queue.buckets
        size = len(piece)
        end = list(range(1, size + 1))       # a node's bytes are piece[i:end[i]]; the next node is at end[i]
        before = list(range(-1, size - 1))
        rank_at = [None] * size              # rank of the pair that starts here

        def pair(i: int) -> None:
            rank = get(piece[i:end[end[i]]]) if end[i] < size else None
            if rank is not None and rank != rank_at[i]:
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    queue.open(rank, [i])
            rank_at[i] = rank

        for i in range(size):
            pair(i)
        while (rank := queue.first()) >= 0:
            i = heappop(buckets[rank])
            if not buckets[rank]:
                queue.close(rank)
            if rank_at[i] != rank:           # stale
                continue
            gone = end[i]
            end[i] = end[gone]
            rank_at[gone] = None
            if end[i] < size:
                before[end[i]] = i
            pair(i)
            if before[i] >= 0:
                pair(before[i])
        out, i = [], 0
        while i < size:
            out.append(self.ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two tokens form, or -1."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def _wait(self, position: np.ndarray, rank: np.ndarray) -> None:
        """Put positions into the buckets of their ranks."""
        order = np.argsort(rank, kind="stable")
        position, rank = position[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        buckets = self.queue.buckets
        for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(position, cuts)):
            if r in buckets:
                buckets[r].append(part)
            else:
                self.queue.open(r, [part])

    def merge_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, one after another, and how many each has."""
        length = np.array([len(w) for w in words], np.int64)
        token = self.single[np.frombuffer(b"".join(words), np.uint8)]
        size = len(token)
        word = np.repeat(np.arange(len(words), dtype=np.int32), length)
        after = np.arange(1, size + 1)
        before = np.arange(-1, size - 1)
        start = np.cumsum(length) - length
        before[start] = -1
        after[start + length - 1] = size     # a node past the end stands for none
        rank_at = np.full(size + 1, -1)
        alive = np.ones(size, bool)
        at = np.flatnonzero(after < size)
        rank_at[at] = self._pair_ranks(token[at], token[at + 1])
        at = at[rank_at[at] >= 0]
        if len(at):
            self._wait(at, rank_at[at])
        while (rank := self.queue.first()) >= 0:
            bucket = self.queue.buckets[rank]
            at = bucket[0] if len(bucket) == 1 else np.sort(np.concatenate(bucket))
            at = at[rank_at[at] == rank]     # the others are stale
            if len(at) > 1:
                same = word[at]
                later = np.concatenate(([False], same[1:] == same[:-1]))
                rest, at = at[later], at[~later]
            else:
                rest = at[:0]
            if len(rest):
                bucket[:] = [rest]
            else:
                self.queue.close(rank)
            if not len(at):
                continue
            gone = after[at]
            right = after[gone]
            after[at] = right
            alive[gone] = False
            rank_at[gone] = -1
            token[at] = rank
            rank_at[at] = -1
            inside = right < size
            lead, right = at[inside], right[inside]
            before[right] = lead
            left = before[at]
            some = left >= 0
            left, here = left[some], at[some]
            place = np.concatenate((lead, left))
            if not len(place):
                continue
            new = self._pair_ranks(token[place], token[np.concatenate((right, here))])
            rank_at[place] = new
            some = new >= 0
            if some.any():
                self._wait(place[some], new[some])
        count = np.bincount(word[alive], minlength=len(words))
        return token[alive], count

    def learn(self, keys: list[str]) -> None:
        """Remember the ids of new chunks, in the order of the index."""
        parts = [self.find(k[2:] if k[:2] == "\n\n" else k if k[:1] == "\n" else " " + k) for k in keys]
        number: dict[str, int] = {}
        flat = np.array([number.setdefault(p, len(number)) for own in parts for p in own], np.int64)
        raw = [p.encode() for p in number]
        whole = [self.ranks.get(w, -1) for w in raw]
        ids = np.array(whole, np.int64)
        start, count = np.arange(len(raw)), np.ones(len(raw), np.int64)
        short = [i for i, w in enumerate(raw) if whole[i] < 0 and len(w) <= LONG]
        if short:
            got, n = self.merge_many([raw[i] for i in short])
            count[short], start[short] = n, len(ids) + np.cumsum(n) - n
            ids = np.concatenate((ids, got))
        for i, w in enumerate(raw):
            if whole[i] < 0 and len(w) > LONG:
                got = self.merge(w)
                count[i], start[i] = len(got), len(ids)
                ids = np.concatenate((ids, np.array(got, np.int64)))
        each = np.array([len(own) for own in parts], np.int64)
        length = np.add.reduceat(np.append(count[flat], 0), np.cumsum(each) - each) * (each > 0)
        self.id_start = np.concatenate((self.id_start, len(self.ids) + np.cumsum(length) - length))
        self.id_length = np.concatenate((self.id_length, length))
        self.ids = np.concatenate((self.ids, ids[ragged(start[flat], count[flat])].astype(np.uint32)))

    def chunks(self, text: str) -> list[str]:
        """Keys of the parts that a text is cut into before the pattern splits each part.

        The pattern lets a match hold a space or line end only as its first character or within a
        run of white space. So a cut before every space and line end that a printing character
        follows changes no match. A key stands for itself after a space; with a line end in
        front, for itself; with two, for what follows them. Texts with other runs of white space
        are split by the pattern at once.
        """
        if self.runs(text):
            return ["\n\n" + p for p in self.find(text)]
        first, *rest = text.replace("\n", " \n").split(" ")
        if first:
            return ["\n\n" + first, *rest]
        return rest

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.index) > self.known:
            self.forget()
        index, had = self.index, len(self.index)
        found = []
        for text in texts:
            keys = self.chunks(text) if text else []
            for k in set(keys).difference(index):
                index[k] = len(index)
            found.append(np.fromiter(map(index.__getitem__, keys), np.int32, len(keys)))
        if len(index) > had:
            self.learn(list(index)[had:])
        return [self.ids[ragged(self.id_start[at], self.id_length[at])] for at in found]

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_start[ids], self.token_length[ids])].tobytes()


@cache
def codec(path: str) -> Codec:
    """One codec in each Python worker, kept between tasks."""
    return Codec(read_ranks(path))


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text",
           ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256, and the packed ids if wanted.

    Each match of the pattern is encoded by itself; there are no special tokens. Null counts as
    empty: no tokens, and hashes of nothing. Only the two named columns are read, so other
    columns cannot clash; repeated rows repeat; an empty table gives an empty one.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def work():
        own = codec(path)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, hashes, back, packed = [], [], [], []
            texts = strings(batch, "text")
            for first, last in pieces(texts, PIECE):
                for got in own.encode_many(texts[first:last]):
                    raw = got.astype("<u4").tobytes()
                    counts.append(len(got))
                    hashes.append(hashlib.sha256(raw).hexdigest())
                    back.append(hashlib.sha256(own.decode(got)).hexdigest())
                    if ids:
                        packed.append(raw)
            columns = {"id": batch.column("id"), "n_tokens": pa.array(counts, pa.int64()),
                       "ids_sha256": pa.array(hashes, pa.string()), "decoded_sha256": pa.array(back, pa.string())}
            if ids:
                columns["ids"] = pa.array(packed, pa.binary())
            return pa.RecordBatch.from_pydict(columns)
        return each

    kind = dict(docs.dtypes)[id_col]
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * ids
    given = docs.select(docs[id_col].alias("id"), docs[text].alias("text"))
    return map_batches(given, work, schema).withColumnRenamed("id", id_col)
