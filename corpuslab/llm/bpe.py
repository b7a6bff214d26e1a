"""Byte-level BPE encoding and decoding: speculate, verify, repair."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Memo, groups, id_and_text

#: Fixed value: the pattern that byte-level vocabularies split text with before merging.
PIECE = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+""",
    regex.V1,
)
#: Unicode white space.  Between a non-space and a space no piece of ``PIECE`` goes on, so text is cut there.
SPACE = "\t-\r \x85\xa0  -     　"
SEGMENT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: Bytes of each of the memo's two generations, which a task leaves empty.
MEMO_BYTES = 32 << 20
#: Longer words are handled one by one.
SHORT = 64
NONE = np.iinfo(np.int32).max


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBpe:
    """Encoder of one vocabulary file.

    *Speculate*: greedy longest match over the vocabulary.  *Verify*: a token sequence
    is what the merges produce exactly when each token is and each adjacent pair is
    compatible, that is, no merge across their border comes before the merges that
    build them up to it; all pairs of all words are tested in one vectorised pass.
    *Repair*: words with a failing pair are merged exactly.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = {bytes(alphabet[c] for c in t): i for t, i in spec["model"]["vocab"].items()}
        self.ids = vocab
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes: list[bytes] = [b""] * size
        for t, i in vocab.items():
            self.bytes[i] = t
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.longest = max(map(len, vocab))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        parts = [tuple(vocab[bytes(alphabet[c] for c in t)] for t in m) for m in pairs]
        self.merge = {p: (rank, vocab[self.bytes[p[0]] + self.bytes[p[1]]]) for rank, p in reversed(list(enumerate(parts)))}
        #: Per token: rank of the merge that builds it (-1: a single byte) and its two parts.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for (a, b), (rank, made) in self.merge.items():
            if self.rank[made] < 0 or rank < self.rank[made]:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_rank = np.array([r for r, _ in self.merge.values()], np.int64)[order]
        built = np.flatnonzero(self.rank >= 0)
        self.sound = np.ones(size, bool)
        self.sound[built] = self.compatible(self.left[built], self.right[built], self.rank[built])
        for t in built[np.argsort(self.rank[built])]:  # parts come before what they build
            self.sound[t] &= self.sound[self.left[t]] & self.sound[self.right[t]]
        self.made = np.array([made for _, (_, made) in sorted((m for m in self.merge.items()), key=lambda m: m[1][0])], np.int64)
        self.made_rank = np.sort(self.pair_rank)
        self.single = np.array([vocab[bytes([b])] for b in range(256)], np.int64)
        self.build_trie()
        self.memo = Memo(MEMO_BYTES)

    def build_trie(self) -> None:
        """Sorted (state, byte) keys with the next state, and the token that ends in each state."""
        step: dict[int, int] = {}
        ends = [-1]
        for t, i in self.ids.items():
            state = 0
            for b in t:
                key = state * 256 + b
                state = step.get(key, 0)
                if not state:
                    state = step[key] = len(ends)
                    ends.append(-1)
            ends[state] = i
        keys, to = np.fromiter(step.keys(), np.int64, len(step)), np.fromiter(step.values(), np.int64, len(step))
        order = np.argsort(keys)
        self.step_keys, self.step_to, self.ends = keys[order], to[order], np.array(ends, np.int64)
        width = 1 << 17
        self.first_steps = np.zeros(width, np.int64)
        self.first_steps[keys[keys < width]] = to[keys < width]

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int) -> np.ndarray:
        """Whether no merge of rank below ``limit`` crosses the border of tokens ``a`` and ``b``.

        The merges of both sides are undone from the last to the first; before each
        step the two tokens at the border must not have a merge that comes earlier
        than the step that was undone.  Of equal ranks the left one comes first.
        """
        u, v = a.astype(np.int64), b.astype(np.int64)
        limit = np.broadcast_to(np.asarray(limit, np.int64), u.shape).copy()
        ok = np.ones(len(u), bool)
        live = np.arange(len(u))
        while len(live):
            key = u[live] * self.size + v[live]
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossed = (self.pair_keys[at] == key) & (self.pair_rank[at] < limit[live])
            ok[live[crossed]] = False
            live = live[~crossed]
            ru, rv = self.rank[u[live]], self.rank[v[live]]
            more = (ru >= 0) | (rv >= 0)
            live, ru, rv = live[more], ru[more], rv[more]
            undo_left = ru > rv
            x, y = live[undo_left], live[~undo_left]
            limit[x], u[x] = ru[undo_left], self.right[u[x]]
            limit[y], v[y] = rv[~undo_left] + 1, self.left[v[y]]
        return ok

    def advance(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next state of each, 0 where no vocabulary entry goes on."""
        key = state * 256 + byte
        out = np.zeros(len(key), np.int64)
        low = key < len(self.first_steps)
        out[low] = self.first_steps[key[low]]
        high = np.flatnonzero(~low)
        at = np.minimum(np.searchsorted(self.step_keys, key[high]), len(self.step_keys) - 1)
        out[high] = np.where(self.step_keys[at] == key[high], self.step_to[at], 0)
        return out

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of the longest vocabulary entry at each place, all words in step."""
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        sizes = np.array([len(w) for w in words], np.int64)
        end = np.cumsum(sizes)
        at = end - sizes
        live = np.flatnonzero(sizes > 0)
        state, best, best_end = np.zeros(len(words), np.int64), np.full(len(words), -1, np.int64), at.copy()
        got_word, got_token = [], []
        while len(live):
            p = at[live]
            inside = p < end[live]
            nxt = np.where(inside, self.advance(state[live], data[p].astype(np.int64)), 0)
            on = nxt > 0
            go, stop = live[on], live[~on]
            state[go] = nxt[on]
            at[go] += 1
            token = self.ends[nxt[on]]
            whole = token >= 0
            best[go[whole]], best_end[go[whole]] = token[whole], at[go[whole]]
            got_word.append(stop)
            got_token.append(best[stop])
            at[stop], state[stop], best[stop] = best_end[stop], 0, -1
            live = np.concatenate([go, stop[at[stop] < end[stop]]])
        if not got_word:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        word, token = np.concatenate(got_word), np.concatenate(got_token)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of tokens, ``NONE`` without one."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_rank[at], NONE).astype(np.int32)

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) by exact merging, all words in step: lowest rank first, leftmost first of equal ranks."""
        sizes = np.array([len(w) for w in words], np.int64)
        n, width = len(words), int(sizes.max(initial=0))
        token = np.full((n, width + 1), -1, np.int64)
        token[:, :width][np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        nxt = np.tile(np.arange(1, width + 2), (n, 1))
        prv = np.tile(np.arange(-1, width), (n, 1))
        rank = np.full((n, width + 1), NONE, np.int32)
        rank[:, :width] = self.ranks(token[:, :-1], token[:, 1:])
        rows = np.arange(n)
        while len(rows):
            i = rank[rows].argmin(axis=1)
            low = rank[rows, i]
            more = low < NONE
            rows, i, low = rows[more], i[more], low[more]
            j = nxt[rows, i]
            token[rows, i] = self.made[np.searchsorted(self.made_rank, low)]
            token[rows, j], rank[rows, j] = -1, NONE
            nxt[rows, i] = k = np.minimum(nxt[rows, j], width)
            prv[rows, k] = i
            rank[rows, i] = self.ranks(token[rows, i], token[rows, k])
            h = prv[rows, i]
            r, h, i = rows[h >= 0], h[h >= 0], i[h >= 0]
            rank[r, h] = self.ranks(token[r, h], token[r, i])
        word, place = np.nonzero(token >= 0)
        return word, token[word, place]

    def merged_long(self, word: bytes) -> list[int]:
        """As ``merged``, for one word of any length."""
        tok: list[int | None] = [int(self.single[b]) for b in word]
        nxt, prv = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap = [(m[0], i, m[1]) for i in range(len(tok) - 1) if (m := self.merge.get((tok[i], tok[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = nxt[i]
            if tok[i] is None or j >= len(tok) or self.merge.get((tok[i], tok[j])) != (rank, made):
                continue
            tok[i], tok[j] = made, None
            nxt[i] = k = nxt[j]
            if k < len(tok):
                prv[k] = i
                if m := self.merge.get((made, tok[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := prv[i]) >= 0 and (m := self.merge.get((tok[h], made))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [t for t in tok if t is not None]

    def greedy_long(self, word: bytes) -> list[int]:
        """As ``greedy``, for one word of any length."""
        ids, out, at = self.ids, [], 0
        while at < len(word):
            stop = next(e for e in range(min(len(word), at + self.longest), at, -1) if word[at:e] in ids)
            out.append(ids[word[at:stop]])
            at = stop
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of words that no merge leaves, all together."""
        long = [i for i, w in enumerate(words) if len(w) > SHORT]
        word, token = self.greedy([w if len(w) <= SHORT else b"" for w in words])
        for i in long:
            guess = self.greedy_long(words[i])
            word, token = np.concatenate([word, np.full(len(guess), i)]), np.concatenate([token, guess])
        inner = np.flatnonzero(word[:-1] == word[1:])
        bad = np.zeros(len(words), bool)
        bad[word[~self.sound[token]]] = True
        bad[word[inner[~self.compatible(token[inner], token[inner + 1], np.iinfo(np.int64).max)]]] = True
        keep = ~bad[word]
        short = np.array([i for i in np.flatnonzero(bad) if len(words[i]) <= SHORT], np.int64)
        at, fixed = self.merged([words[i] for i in short])
        word, token = np.concatenate([word[keep], short[at]]), np.concatenate([token[keep], fixed])
        order = np.argsort(word, kind="stable")
        packed = token[order].astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(word, minlength=len(words))) * 4).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        for i in long:
            if bad[i]:
                out[i] = np.array(self.merged_long(words[i]), "<u4").tobytes()
        return out

    def encode_segments(self, segments: list[str]) -> list[bytes]:
        """Packed little-endian uint32 ids of each segment."""
        pieces = [PIECE.findall(s) for s in segments]
        words = list({p for ps in pieces for p in ps})
        made = dict(zip(words, self.encode_words([w.encode("utf-8", "surrogatepass") for w in words])))
        return [made[ps[0]] if len(ps) == 1 else b"".join([made[p] for p in ps]) for ps in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts; the strings of added tokens inside a text become these tokens."""
        marks = sorted(self.special, key=len, reverse=True)
        cut = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        rows = []
        for text in texts:
            if cut and any(m in text for m in marks):
                rows.append([x for part in cut.split(text) for x in ([part] if part in self.special else SEGMENT.findall(part))])
            else:
                rows.append(SEGMENT.findall(text))
        known = self.memo.get((s for row in rows for s in row if s not in self.special), self.encode_segments)
        packed = {m: i.to_bytes(4, "little") for m, i in self.special.items()}
        return [b"".join([known[s] if s in known else packed[s] for s in row]) for row in rows]

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; byte sequences that are no UTF-8 become replacement characters, unknown ids nothing."""
        table = self.bytes
        return b"".join([table[t] for t in np.frombuffer(packed, "<u4").tolist() if t < len(table)]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """One encoder and memo per Python worker."""
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): token ids of every whole text; null counts as empty, whose ids are an empty array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in batches:
                for part, texts in groups(batch):
                    packed = [np.frombuffer(x, "<u4").astype(np.int32) for x in bpe.encode(texts)]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.list_(pa.int32()))], ["doc_id", "ids"])
        finally:
            bpe.memo.clear()

    d = id_and_text(docs, id_col, text_col)
    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text): the text of each array of ids; null ids give null."""
    d = encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [None if x is None else bpe.decode(np.array(x, "<u4").tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, same_text): digests of each text's ids and of the text decoded from them.

    Null counts as empty (0 tokens).  One row per input row, in one pass; ties, repeated
    rows and null ids pass through; an empty table gives no rows.
    """
    d = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        try:
            for batch in batches:
                for part, texts in groups(batch):
                    packed = bpe.encode(texts)
                    decoded = [bpe.decode(x) for x in packed]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            pa.array([len(x) // 4 for x in packed], pa.int64()),
                            pa.array([sha256(x).hexdigest() for x in packed]),
                            pa.array([sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in decoded]),
                            pa.array([x == y for x, y in zip(texts, decoded)]),
                        ],
                        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "same_text"],
                    )
        finally:
            bpe.memo.clear()

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean")
