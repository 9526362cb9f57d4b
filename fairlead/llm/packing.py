"""Documents put together into containers of fixed capacity with little room left.

Large sizes are rounded up within groups of equal cardinality (linear grouping), so that few sizes remain; the linear
programme over configurations of these sizes is solved by column generation; its whole part is filled with the actual
documents, and what is left, small documents above all, goes where it fits best. Documents are hashed to shards, which
are packed independently, so no task ever holds more than a shard and all shards together leave at most one
half-empty container each behind.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairlead.schema import require
from fairlead.session import settle


MOST_PACKS = 1_000


# How the byte-level vocabularies part a text before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _counter(vocabulary: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts under a vocabulary file: ranks of tiktoken (*.tiktoken) or a tokenizer of tokenizers (*.json)."""
    if vocabulary.endswith(".tiktoken"):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda texts: [len(encode(t)) for t in texts]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tokens) of every document; null and empty texts have none. Whole texts are encoded, in Arrow batches.

    ``vocabulary`` is the path of a public tokenizer's file, which every executor must be able to read.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = _counter(vocabulary)
        for batch in batches:
            sizes = []
            for at in range(0, len(batch), 256):
                sizes += counts([t if isinstance(t, str) else "" for t in batch[text][at : at + 256]])
            yield pd.DataFrame({key: batch[key], "tokens": np.array(sizes, np.int64)})

    kind = dict(docs.dtypes)[key]
    return require(docs, key, text).mapInPandas(count, f"{key} {kind}, tokens bigint")


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 900) -> list[tuple[np.ndarray, int]]:
    """(items of each size, times) of the whole part of the best fractional packing, by column generation."""
    m = len(sizes)
    # Groups of equal cardinality make the programme degenerate; demands a little apart keep its steps from circling.
    s, d = np.array(sizes), np.array(demand, float) + 0.02 * np.random.default_rng(m).random(m)
    columns = np.diag([float(capacity // x) for x in sizes])
    for _ in range(rounds):
        worth = np.linalg.solve(columns.T, np.ones(m))
        best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for i in np.argsort(-s):  # unbounded knapsack over the dual values, a size at a time
            if worth[i] <= 1e-9:
                continue
            for start in range(s[i], capacity + 1, s[i]):
                end = min(start + s[i], capacity + 1)
                new = best[start - s[i] : end - s[i]] + worth[i]
                better = new > best[start:end] + 1e-12
                best[start:end][better] = new[better]
                pick[start:end][better] = i
        at = int(np.argmax(best))
        if best[at] <= 1 + 1e-7:
            break
        column = np.zeros(m)
        while at > 0 and pick[at] >= 0:
            column[pick[at]] += 1
            at -= s[pick[at]]
        x, y = np.linalg.solve(columns, d), np.linalg.solve(columns, column)
        ratio = np.where(y > 1e-9, x / np.where(y > 1e-9, y, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        columns[:, leave] = column
    x = np.floor(np.maximum(np.linalg.solve(columns, np.array(demand, float)), 0) + 1e-9).astype(int)
    return [(columns[:, k].astype(int), int(x[k])) for k in range(m) if x[k] > 0]


def pack(sizes: np.ndarray, capacity: int, groups: int = 64, large: float = 1 / 8) -> np.ndarray:
    """Container number of each item; sizes lie between 0 and capacity."""
    out = np.full(len(sizes), -1, np.int64)
    used = 0
    room: list[int] = []

    def open_with(items: list[int]) -> None:
        nonlocal used
        out[items] = used
        room.append(capacity - int(sizes[items].sum()))
        used += 1

    for i in np.flatnonzero(sizes == capacity):
        open_with([i])
    big = np.flatnonzero((sizes > capacity * large) & (sizes < capacity))
    big = big[np.argsort(-sizes[big], kind="stable")]
    left: list[int] = []
    if len(big):
        stock: dict[int, list[int]] = defaultdict(list)
        for part in np.array_split(big, max(1, min(groups, len(big) // 8))):
            stock[int(sizes[part].max())].extend(part.tolist())  # rounded up to the group's largest
        levels = sorted(stock)
        for column, times in configurations(levels, [len(stock[x]) for x in levels], capacity):
            for _ in range(times):
                items = [stock[x].pop() for x, n in zip(levels, column, strict=True) for _ in range(min(n, len(stock[x])))]
                if items:
                    open_with(items)
        left = [i for x in levels for i in stock[x]]
    rest = np.array([*left, *np.flatnonzero(sizes <= capacity * large)], np.int64)
    rest = rest[np.argsort(-sizes[rest], kind="stable")]
    # Best fit: containers by room; a bit for each room that some container has finds the least that is enough.
    by_room: dict[int, list[int]] = defaultdict(list)
    mask = 0
    for k, r in enumerate(room):
        by_room[r].append(k)
        mask |= 1 << r
    for i in rest:
        size = int(sizes[i])
        enough = mask >> size
        if enough:
            r = size + (enough & -enough).bit_length() - 1
            k = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
        else:
            k, r = used, capacity
            used += 1
        out[i] = k
        by_room[r - size].append(k)
        mask |= 1 << (r - size)
    return out


def pack_documents(docs: DataFrame, capacities: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", shard_pieces: int = 20_000) -> DataFrame:
    """(pack_id, doc_id, piece, start_token, tokens, container) of every document or piece, for every capacity.

    capacities: pack_id, capacity_tokens; there are few. A document that exceeds the capacity is cut into pieces of the
    capacity and one rest; no other is cut. Documents without tokens take part with size 0. Capacities that are null or
    not positive give no rows. Containers are named within a pack, by shard and number or by document
    and piece. Pieces that fill a container need no packing; the
    others of a pack, at most one for each document, are hashed to shards of about ``shard_pieces``, each of which is
    packed by one task. Tokens are counted with ``vocabulary`` (see token_counts).
    """
    packs = require(capacities, "pack_id", "capacity_tokens").where("capacity_tokens > 0").distinct().limit(MOST_PACKS + 1).collect()
    if len(packs) > MOST_PACKS:
        raise ValueError(f"more than {MOST_PACKS} container sizes")
    sizes = settle(token_counts(docs, vocabulary, key, text).select(F.col(key).cast("bigint").alias("doc_id"), "tokens"))
    shards = max(1, -(-sizes.count() // shard_pieces))
    kind = "array<struct<pack_id:int,capacity_tokens:bigint>>"
    each = F.explode(F.array(*[F.struct(F.lit(p.pack_id).cast("int").alias("pack_id"), F.lit(p.capacity_tokens).cast("bigint").alias("capacity_tokens")) for p in packs]).cast(kind))
    whole = sizes.withColumn("_p", each).select("doc_id", "tokens", "_p.*").withColumn("full", F.floor(F.col("tokens") / F.col("capacity_tokens")).cast("int"))
    full = whole.where("full > 0").select("pack_id", "doc_id", F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece"), "capacity_tokens")
    own = full.select("pack_id", "doc_id", "piece", (F.col("piece") * F.col("capacity_tokens")).alias("start_token"), F.col("capacity_tokens").alias("tokens"), F.concat_ws(":", F.lit("d"), "doc_id", "piece").alias("container"))
    rest = whole.where((F.col("tokens") == 0) | (F.col("tokens") > F.col("full") * F.col("capacity_tokens")))
    rest = rest.select("pack_id", "capacity_tokens", "doc_id", F.col("full").alias("piece"), (F.col("full") * F.col("capacity_tokens")).alias("start_token"), (F.col("tokens") - F.col("full") * F.col("capacity_tokens")).alias("tokens"))
    rest = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece"], kind="stable")
        got = pack(rows["tokens"].to_numpy(np.int64), int(rows["capacity_tokens"].iloc[0]))
        return rows.assign(number=got)[["pack_id", "doc_id", "piece", "start_token", "tokens", "shard", "number"]]

    # A task for each group: left to itself, adaptive execution puts many small groups, which are much work, into one.
    spread = rest.repartition(max(1, 2 * shards * len(packs)), "pack_id", "shard")
    packed = spread.groupBy("pack_id", "shard").applyInPandas(run, "pack_id int, doc_id bigint, piece int, start_token bigint, tokens bigint, shard int, number bigint")
    return packed.select("pack_id", "doc_id", "piece", "start_token", "tokens", F.concat_ws(":", F.lit("s"), "shard", "number").alias("container")).unionByName(own)
