"""Byte-pair encoding with a pair occurrence index, and decoding.

The words new to a block of documents are laid out as one chain of symbols. An index maps each pair
that has a merge rule to all its positions in the block. The active ranks, those of pairs that occur,
wait in a heap and are applied in ascending order; a merge touches only the lists of the pairs beside
it. Words already encoded are remembered up to a fixed number, so memory does not grow with the table.

Defined results: a null or empty text has no ids and decodes to the empty text; special tokens written
in a text get their own ids, as the tokenizers library does; repeated rows give repeated results; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomesh.llm.tokens import SPACE, TextEncoder


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Bpe:
    """The vocabulary and merge rules of a tokenizer file, and their application."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max(*vocab.values(), *self.special.values())
        self.token: list[str] = [""] * size
        for text, i in (*vocab.items(), *self.special.items()):
            self.token[i] = text
        self.size = size
        self.rules: list[tuple[int, int, int]] = []
        born: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self.token[a] + self.token[b]]
            if max(born.get(a, -1), born.get(b, -1)) > rank:
                raise ValueError("a merge rule comes before the rules that make its parts")
            born.setdefault(made, rank)
            self.rules.append((a, b, made))
        keys = np.array([a * size + b for a, b, _ in self.rules], np.int64)
        self.key_ranks = np.argsort(keys)
        self.keys = keys[self.key_ranks]
        letters = byte_letters()
        self.inner = np.array([vocab[x] for x in letters])
        self.last = np.array([vocab[x + suffix] for x in letters])
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def pieces(self, text: str) -> list[str]:
        """Pieces of normalised text that are encoded one by one."""
        folded = "".join(map(str.lower, unicodedata.normalize("NFC", text))) if not text.isascii() else text.lower()
        return self.split.findall(folded)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merge rule, -1 where there is none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.key_ranks[at], -1)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers; all go through the merges together."""
        if not pieces:
            return []
        raw = [p.encode() for p in pieces]
        stops = np.cumsum([len(x) for x in raw])
        starts = np.concatenate(([0], stops[:-1]))
        letters = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[letters]
        sym[stops - 1] = self.last[letters[stops - 1]]
        after = np.arange(1, len(sym) + 1)
        before = np.arange(-1, len(sym) - 1)
        after[stops - 1] = -1
        before[starts] = -1

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(ranks: np.ndarray, positions: np.ndarray) -> None:
            """Enter positions under the ranks of the pairs that begin there."""
            there = ranks >= 0
            ranks, positions = ranks[there], positions[there]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for rank, x, y in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
                if rank in index:
                    index[rank].append(positions[x:y])
                else:
                    index[rank] = [positions[x:y]]
                    heapq.heappush(active, rank)

        begins = np.flatnonzero(after >= 0)
        add(self.ranks(sym[begins], sym[begins + 1]), begins)
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b, made = self.rules[rank]
            to = after[at]
            real = (to >= 0) & (sym[at] == a)
            real &= sym[to] == b
            at, to = at[real], to[real]
            if a == b and len(at) > 1:
                # of overlapping pairs every second one, from the left
                fresh = np.concatenate(([True], at[1:] != to[:-1]))
                runs = np.flatnonzero(fresh)
                even = (np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2 == 0
                at, to = at[even], to[even]
            if not len(at):
                continue
            nxt = after[to]
            sym[at], sym[to], after[at] = made, -1, nxt
            follows = nxt >= 0
            left, right = at[follows], nxt[follows]
            before[right] = left
            prev = before[at]
            prev = prev[prev >= 0]
            pair = np.concatenate((left, prev))
            add(self.ranks(sym[pair], sym[after[pair]]), pair)

        live = sym >= 0
        cut = np.concatenate(([0], np.cumsum(live)))
        ids = sym[live].astype("<u4").tobytes()
        return [ids[x:y] for x, y in zip((cut[starts] * 4).tolist(), (cut[stops] * 4).tolist())]

    def encode_runs(self, words: list[str]) -> list[bytes]:
        """Ids of words that are one run of letters."""
        folded = [w.lower() if "\u03a3" not in w else "".join(map(str.lower, w)) for w in words]
        distinct = list(set(folded))
        found = dict(zip(distinct, self.encode_pieces(distinct)))
        return [found[x] for x in folded]

    def encode_others(self, words: list[str]) -> list[bytes]:
        """Ids of any words; special tokens written in them count as such."""
        cut = [[self.special.get(part, part) for part in (self.cut.split(w) if self.cut else [w])] for w in words]
        cut = [[p if isinstance(p, int) else self.pieces(p) for p in parts] for parts in cut]
        distinct = list({p for parts in cut for ps in parts if isinstance(ps, list) for p in ps})
        found = dict(zip(distinct, self.encode_pieces(distinct)))
        return [b"".join(x for ps in parts for x in
                         ([ps.to_bytes(4, "little")] if isinstance(ps, int) else [found[p] for p in ps])) for parts in cut]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; the file names no decoder, so tokens stand apart."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=1)
def load(path: str) -> tuple[Bpe, TextEncoder]:
    """Rules and encoder of a tokenizer file, kept by the worker from task to task."""
    bpe = Bpe(path)
    return bpe, TextEncoder(bpe.encode_runs, bpe.encode_others)


def encode_decode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    ``path`` is a tokenizer file that every executor has.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, encoder = load(path)
        for b in batches:
            counts, digests, decoded, out = [], [], [], []
            for raw in encoder.encode([t or "" for t in b.column("text").to_pylist()]):
                ids = np.frombuffer(raw, "<u4")
                counts.append(len(ids))
                digests.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids.tolist()).encode()).hexdigest())
                if with_ids:
                    out.append(ids.astype(np.int64))
            columns = [b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(out, pa.list_(pa.int64()))] if with_ids else []), names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
