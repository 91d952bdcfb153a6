"""Best-fit packing of tokenised documents into fixed-length sequences.

Lengths matter, not rows: the histogram of piece lengths has at most ``capacity`` entries whatever the data. The
configuration linear program (a configuration is a multiset of lengths that fits one sequence; every length must be covered
as often as it occurs, by as few configurations as possible) is solved over that histogram by multiplicative weights: each
length has a price, a knapsack dynamic program finds the configuration of the highest total price, it is taken, and the
prices of the lengths it covers fall. The fractional solution is rounded down; the sequences so opened keep their gaps, and
what is left over goes best-fit, longest first, into gaps or new sequences. Ranks within a length, which many tasks number,
then map every piece to its sequence.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import free_names, ready, running, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

_ENCODERS: dict[str, object] = {}

#: runs of white space (as Unicode defines it) that the encoder's pattern would back out of one character at a time, beyond
#: its stack for very long ones
LONG_BLANKS = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{1000,}")


def encoder(path: str):
    """``text -> uint32 ids`` of the byte-level BPE tokenizer file at ``path`` (special strings in a text are read as the
    file's special tokens, none are added). tiktoken applies the file's own vocabulary about eight times as fast as the
    ``tokenizers`` library; the tests hold its ids against that library's."""
    if path not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the file writes a byte as a printable character: itself, or the next free one from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        enc = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> np.ndarray:
            parts, at = [], 0
            for m in LONG_BLANKS.finditer(text):
                # the pattern's own rule: a run is one word, but for its last character if something follows in its part
                # of the text (special strings divide it before)
                end = m.end() - (m.end() < len(text) and not text.startswith(tuple(special), m.end()))
                parts.append(enc.encode_to_numpy(text[at : m.start()], allowed_special="all"))
                parts.append(np.array(enc._encode_single_piece(text[m.start() : end]), np.uint32))
                at = end
            parts.append(enc.encode_to_numpy(text[at:], allowed_special="all"))
            return np.concatenate(parts) if len(parts) > 1 else parts[0]

        _ENCODERS[path] = encode
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs`` (doc_id, text; other columns are ignored).

    A document is its ids and then ``end_id``; a null text is empty, so it is that one id. Only documents longer than
    ``capacity`` are cut; what does not fill a piece comes first. Rows that repeat a doc_id are cut each for themselves.
    """

    def cut(batches):
        encode = encoder(tokenizer)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"], b["text"], strict=True):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                at, n, piece = 0, len(ids), 0
                while at < n:
                    size = min(capacity, (n - at) % capacity or capacity)
                    rows.append((doc, piece, at, size, zlib.crc32(ids[at : at + size].tobytes())))
                    at, piece = at + size, piece + 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return ready(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, PIECES)


def best_configuration(price: np.ndarray, have: np.ndarray, capacity: int) -> dict[int, int]:
    """The knapsack dynamic program: the multiset of lengths with the highest total price within ``capacity``, as
    {length: count}. ``price[l]`` is the price of length l + 1 (below 0 where none is left)."""
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        v = price[:c] + best[c - 1 :: -1][:c]
        i = int(v.argmax())
        if v[i] > best[c - 1]:
            best[c], pick[c] = v[i], i + 1
        else:
            best[c] = best[c - 1]
    out, c = {}, capacity
    while c > 0:
        if pick[c]:
            out[int(pick[c])] = out.get(int(pick[c]), 0) + 1
            c -= int(pick[c])
        else:
            c -= 1
    return {x: min(n, int(have[x - 1])) for x, n in out.items()}


def first_prices(need: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Prices to start from and the lower bound that they prove. For any threshold, lengths above ``capacity`` less the
    threshold are worth a sequence, those below the threshold nothing, others their share: no configuration is worth more
    than 1, so the worth of all pieces bounds the number of sequences. The threshold of the best bound is taken (0 gives
    the volume); a trace of the shares breaks ties towards full sequences."""
    lengths = np.arange(1, capacity + 1)
    share = lengths / capacity
    best, bound = share, float(need @ share)
    for k in range(1, capacity // 2 + 1):
        worth = np.where(lengths > capacity - k, 1.0, np.where(lengths < k, 0.0, share))
        if need @ worth > bound:
            best, bound = worth, float(need @ worth)
    return 0.98 * best + 0.02 * share, max(1.0, bound)


def solve(histogram: dict[int, int], capacity: int, rounds: int = 600, step: float = 0.3, rate: float = 1.0, between: int = 8) -> list[tuple[dict[int, int], int]]:
    """[(configuration, how many sequences of it)] that holds exactly the pieces of ``histogram`` ({length: count}).

    ``rounds`` knapsack programs price new configurations; before each, ``between`` steps of multiplicative weights choose
    among those known. ``rounds`` bounds the configurations, hence the plan: that many entries, and what rounding leaves of
    them. Any number of rounds gives a valid packing.
    """
    plan: list[tuple[dict[int, int], int]] = []
    need = np.zeros(capacity, np.int64)
    for x, n in histogram.items():
        if x == capacity:
            plan.append(({x: 1}, int(n)))
        else:
            need[x - 1] = n
    if not need.any():
        return plan
    lengths = np.arange(1, capacity + 1)
    start, bins = first_prices(need, capacity)
    cover = np.zeros(capacity)  # times that each length is covered so far
    price = start.copy()
    configs: list[tuple[tuple[int, int], ...]] = []
    known: set[tuple] = set()
    amount: list[float] = []
    at, count, begin = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)

    def add(i: int) -> None:
        where, k = at[begin[i] : begin[i] + len(configs[i])], count[begin[i] : begin[i] + len(configs[i])]
        t = max(1e-9, float((need[where] / k).min()) * step)
        amount[i] += t
        cover[where] += t * k / need[where]
        price[where] = start[where] * np.exp(-rate * np.clip(cover[where] - low, 0, 30 / rate))

    for _ in range(rounds):
        low = float(cover[need > 0].min())
        price = start * np.exp(-rate * np.clip(cover - low, 0, 30 / rate))
        key = tuple(sorted(best_configuration(np.where(need > 0, price, -1.0), need, capacity).items()))
        if key not in known:
            known.add(key)
            begin = np.append(begin, len(at))
            at, count = np.append(at, [x - 1 for x, _ in key]).astype(np.int64), np.append(count, [k for _, k in key])
            configs.append(key)
            amount.append(0.0)
            add(len(configs) - 1)
        for _ in range(between):
            add(int(np.add.reduceat(price[at] * count, begin).argmax()))
    # no length more often than it occurs, and no more sequences than the lower bound; then round down
    scale = min(bins / sum(amount), 1 / float(cover.max()))
    left = need.copy()
    opened: list[tuple[dict[int, int], int]] = []
    for i in sorted(range(len(configs)), key=lambda i: -sum(x * k for x, k in configs[i])):
        n = int(min(np.floor(amount[i] * scale), min(left[x - 1] // k for x, k in configs[i])))
        if n > 0:
            opened.append((dict(configs[i]), n))
            for x, k in configs[i]:
                left[x - 1] -= n * k
    return plan + best_fit(opened, left, capacity)


def best_fit(opened: list[tuple[dict[int, int], int]], left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Puts the ``left`` pieces, longest first, each where the least room stays: into sequences of ``opened`` (kept as
    counts, so equal sequences stay one entry) or into new ones. ``left`` is bounded by the rounding, not by the data."""
    room: dict[int, list[tuple[dict[int, int], int]]] = {}
    for c, n in opened:
        room.setdefault(capacity - sum(x * k for x, k in c.items()), []).append((c, n))
    gaps = sorted(g for g in room if g > 0)
    for x in range(capacity, 0, -1):
        todo = int(left[x - 1])
        while todo:
            i = bisect.bisect_left(gaps, x)
            if i == len(gaps):
                fit = capacity // x
                n = todo // fit
                new = [({x: fit}, n)] if n else []
                if todo % fit:
                    new.append(({x: todo % fit}, 1))
                todo = 0
            else:
                c, n = room[gaps[i]].pop()
                if not room[gaps[i]]:
                    gaps.pop(i)
                m = min(n, todo)
                new = [(c | {x: c.get(x, 0) + 1}, m)] + ([(c, n - m)] if n > m else [])
                todo -= m
            for c, n in new:
                g = capacity - sum(y * k for y, k in c.items())
                if g not in room or not room[g]:
                    room[g] = []
                    if g > 0:
                        bisect.insort(gaps, g)
                room[g].append((c, n))
    return [x for own in room.values() for x in own]


def places(plan: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """Where the pieces of a length go, by rank: rows (length, rank0, first sequence, pieces a sequence, offset)."""
    rows, seq, rank = [], 0, {}
    for c, n in plan:
        at = 0
        for x, k in sorted(c.items(), reverse=True):
            if k:
                rows.append((x, rank.get(x, 0), seq, k, at))
                rank[x] = rank.get(x, 0) + n * k
                at += x * k
        seq += n
    out = pd.DataFrame(rows, columns=["length", "rank0", "seq0", "each", "offset"]).astype("int64")
    return out.sort_values(["length", "rank0"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = 2048, rounds: int = 600) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32; lengths 1 to ``capacity``) with ``sequence_id`` and ``offset``
    (columns of these names are replaced; other columns stay).

    Every sequence is gapless from offset 0. Only the histogram (at most ``capacity`` rows) and the plan made from it reach
    the driver. Pieces equal in all columns are interchangeable; no piece gives no sequence.
    """
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in histogram):
        raise ValueError(f"lengths must be 1 to {capacity}")
    p = places(solve(histogram, capacity, rounds)) if histogram else pd.DataFrame(columns=["length", "rank0", "seq0", "each", "offset"], dtype="int64")
    table = pieces.sparkSession.sparkContext.broadcast([p[c].to_numpy() for c in ("length", "rank0", "seq0", "each", "offset")])

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        ls, r0, s0, each, off = table.value
        big = np.int64(1) << np.int64(44)
        i = np.searchsorted(ls * big + r0, length.to_numpy() * big + rank.to_numpy(), "right") - 1
        d = rank.to_numpy() - r0[i]
        return pd.DataFrame({"sequence_id": s0[i] + d // each[i], "offset": off[i] + d % each[i] * length.to_numpy()})

    place = F.pandas_udf(place, "sequence_id long, offset long")
    rank, to = free_names(pieces.columns, "rank", "to")
    ranked = running(pieces, ["length"], ["doc_id", "piece", "start", "ids_crc32"], F.lit(1), rank)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return ranked.withColumn(to, place("length", rank)).select(*kept, f"{to}.sequence_id", f"{to}.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, rounds: int = 600) -> DataFrame:
    """Tokenises, cuts and packs ``docs``; the pieces (no ids) are written once and read by the later steps."""
    return pack(written(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity, rounds)
