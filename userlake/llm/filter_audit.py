"""What each of five filters removes, in every order in which they can run.

Documents arrive as files, taken in micro-batches of a stream that ends when
all are read. A document is reduced to the filters that it fails by itself (A to
D, a mask) and a digest of its text. Filter E, a repeat of a text with a smaller
doc_id, depends on all documents: the state of a text is its smallest doc_id so
far with the labels of that row. A row that comes later with a larger id fails E
at once; one with a smaller id takes the place of the row that was counted as
the first, whose mask is then retracted from the counters and counted again with
E. Counters are by part, mask and labels; each micro-batch writes its own
changes, so that a repeated batch replaces them. All orders follow from the
counters: a filter removes the documents that fail it and none before it.

Texts are dealt to buckets by their digest, and the state store holds the texts
of a bucket as one value: most texts occur once, and calling the stateful step
for each would cost more than all the rest. Buckets grow in number with the
documents, so that each stays small. Of the rows of one text a task sends on
only those that may be the first, and sums the others, so that a text with very
many copies brings a row from each task. With large state, run on the RocksDB
state store; the default keeps it in memory.

Defined cases: a null text is the empty one; a null lang is the part of the
empty string; a row without doc_id never fails E, makes no other row fail it
and has no labels; rows of one doc_id and one text are the same distance from
E; of several labels of a doc_id one that is set counts; an empty table gives
an empty result; texts are read whole; further columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from userlake.llm.common import stored
from userlake.sources.scratch import scratch_folder

FILTERS = "ABCDE"
A, B, C, D, E = (1 << i for i in range(5))
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITAL_PERCENT = 10
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(0x41, 0x5B))
# Micro-batches into which the files are dealt.
MICRO_BATCHES = 4
# Texts of which a task holds the first row before it passes them on.
HELD_TEXTS = 200_000
# Documents for which there is one more bucket; a bucket's state is some 80 bytes for each of its texts.
DOCUMENTS_PER_BUCKET = 20_000
# Documents without doc_id have no label; they are spread over this many keys of the join.
NULL_KEYS = 64

FLAGGED = "doc_id bigint, part string, text_key binary, mask int"
CHANGE = "part string, mask int, good boolean, toxic boolean, n bigint"
# `settled` rows are sums whose E is known; they have no doc_id of their own (0, as a null would turn ids into floats).
ARRIVAL = "text_key binary, settled boolean, doc_id bigint, " + CHANGE
STATE = "texts binary"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failed_filters(text: str) -> int:
    """The mask of the filters A to D that a text fails."""
    data = text.encode()
    words = data.split()
    mask = A if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words):
        mask |= B
    if 100 * (len(data) - len(data.translate(None, CAPITALS))) > MAX_CAPITAL_PERCENT * len(text):
        mask |= C
    return mask | D if SYMBOLS.search(data) else mask


def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, part, digest of the text and mask of each document."""
    for batch in batches:
        keys, masks = [], []
        for value in batch.column("text"):
            text = value.as_py() or ""
            keys.append(hashlib.sha256(text.encode()).digest())
            masks.append(failed_filters(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
            ["doc_id", "part", "text_key", "mask"],
        )


def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task that may be the first of their text, and sums of all others.

    A sum is settled. It goes under the digest of one of its texts.
    """
    first: dict[bytes, tuple[int, int, Counter]] = {}
    final: dict[tuple, list] = {}

    def close(key: bytes, mask: int, rows: Counter) -> None:
        for (part, good, toxic), n in rows.items():
            final.setdefault((part, mask, good, toxic), [key, 0])[1] += n

    def release() -> Iterator[pa.RecordBatch]:
        rows = [
            (key, False, doc_id, part, mask, good, toxic, n)
            for key, (doc_id, mask, held) in first.items()
            for (part, good, toxic), n in held.items()
        ]
        rows += [(key, True, 0, *what, n) for what, (key, n) in final.items()]
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at : at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ARRIVAL_ARROW.types)], schema=ARRIVAL_ARROW)
        first.clear()
        final.clear()

    for batch in batches:
        names = ("text_key", "doc_id", "part", "mask", "good", "toxic")
        for key, doc_id, part, mask, good, toxic in zip(*(batch.column(c).to_pylist() for c in names)):
            row = (part, good, toxic)
            held = first.get(key)
            if doc_id is None:
                close(key, mask, Counter([row]))
            elif held is None or doc_id < held[0]:
                if held is not None:
                    close(key, mask | E, held[2])
                first[key] = (doc_id, mask, Counter([row]))
            elif doc_id == held[0]:
                held[2][row] += 1
            else:
                close(key, mask | E, Counter([row]))
        if len(first) > HELD_TEXTS:
            yield from release()
    yield from release()


ARRIVAL_ARROW = pa.schema(
    [
        ("text_key", pa.binary()), ("settled", pa.bool_()), ("doc_id", pa.int64()), ("part", pa.string()),
        ("mask", pa.int32()), ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64()),
    ]
)


def changes_of_text(
    state: tuple[int, int, list] | None, arrivals: list[tuple]
) -> tuple[tuple[int, int, list] | None, list[tuple]]:
    """The new state of a text (first doc_id, mask, [part, good, toxic, n] of that row) and the changes of the counters."""
    changes = []
    for settled, doc_id, part, mask, good, toxic, n in arrivals:
        row = [part, good, toxic, n]
        if settled:
            changes.append((part, mask, good, toxic, n))
        elif state is None or doc_id <= state[0]:
            if state is not None and doc_id < state[0]:
                for held_part, held_good, held_toxic, held_n in state[2]:
                    changes.append((held_part, mask, held_good, held_toxic, -held_n))
                    changes.append((held_part, mask | E, held_good, held_toxic, held_n))
            held = state[2] if state is not None and doc_id == state[0] else []
            state = (doc_id, mask, [*held, row])
            changes.append((part, mask, good, toxic, n))
        else:
            changes.append((part, mask | E, good, toxic, n))
    return state, changes


KEPT_ARROW = pa.schema(
    [
        ("text_key", pa.binary()), ("first", pa.int64()), ("mask", pa.int32()), ("part", pa.string()),
        ("good", pa.bool_()), ("toxic", pa.bool_()), ("n", pa.int64()),
    ]
)


def load_texts(state: bytes) -> dict[bytes, tuple[int, int, list]]:
    """The texts of a bucket from its state; a first row that is held several times has a row for each."""
    texts: dict[bytes, tuple[int, int, list]] = {}
    for key, first, mask, *row in zip(*(c.to_pylist() for c in pa.ipc.open_stream(state).read_all().columns)):
        texts.setdefault(key, (first, mask, []))[2].append(row)
    return texts


def dump_texts(texts: dict[bytes, tuple[int, int, list]]) -> bytes:
    rows = [(key, first, mask, *row) for key, (first, mask, held) in texts.items() for row in held]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), KEPT_ARROW.types)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, KEPT_ARROW) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays(columns, schema=KEPT_ARROW))
    return sink.getvalue().to_pybytes()


def update_texts(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The stateful step: `changes_of_text` for each text of a bucket that a micro-batch brings rows for."""
    texts = load_texts(state.get[0]) if state.exists else {}
    total: Counter = Counter()
    moved = False
    for frame in frames:
        columns = (frame[c].tolist() for c in ("text_key", "settled", "doc_id", "part", "mask", "good", "toxic", "n"))
        for key, *arrival in zip(*columns):
            key = bytes(key)
            kept = texts.get(key)
            now, changes = changes_of_text(kept, [arrival])
            if now is not kept:
                texts[key], moved = now, True
            for *what, n in changes:
                total[tuple(what)] += n
    if moved:
        state.update((dump_texts(texts),))
    rows = [(*what, n) for what, n in total.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def label_flags(labels: DataFrame) -> DataFrame:
    """good and toxic of each labelled doc_id."""
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_doc")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )


def stream_changes(documents: DataFrame, flags: DataFrame, buckets: int) -> DataFrame:
    """Changes of the counters as documents arrive, from a streaming DataFrame and the stored `label_flags`."""
    part = F.coalesce(F.col("lang"), F.lit("")).alias("part")
    flagged = documents.select("doc_id", part, "text").mapInArrow(flag, FLAGGED)
    no_id = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text_key"), F.lit(NULL_KEYS))).otherwise(-1)
    labels = flags.withColumn("_no_id", F.lit(-1).cast("bigint"))
    known = flagged.withColumn("_place", no_id).join(
        labels, (F.col("doc_id") == F.col("_doc")) & (F.col("_place") == F.col("_no_id")), "left"
    )
    no = F.lit(False)
    rows = known.select(
        "text_key", "doc_id", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )
    return (
        rows.mapInArrow(settle, ARRIVAL)
        .withColumn("bucket", F.pmod(F.xxhash64("text_key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(update_texts, CHANGE, STATE, "update", GroupStateTimeout.NoTimeout)
    )


def _as_pattern(path: str) -> str:
    """A pattern that only `path` meets: a stream reads a single file under a pattern, though not under its plain name."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def count_documents(
    spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES
) -> DataFrame:
    """The counters (part, mask, good, toxic, n) after all files under `path` have been read."""
    flags = stored(label_flags(labels), "audit-labels")
    root = scratch_folder(spark, "audit")
    counters = f"{root}/counters"
    spark.createDataFrame([], CHANGE).write.parquet(f"{counters}/batch=-1")
    found = spark.read.parquet(path)
    files_at_once = max(1, -(-len(found.inputFiles()) // micro_batches))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-found.count() // DOCUMENTS_PER_BUCKET))

    def add(changes: DataFrame, batch_id: int) -> None:
        summed = changes.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.coalesce(1).write.mode("overwrite").parquet(f"{counters}/batch={batch_id}")

    documents = spark.readStream.schema(found.schema).option("maxFilesPerTrigger", files_at_once).parquet(_as_pattern(path))
    stream = (
        stream_changes(documents, flags, buckets)
        .writeStream.outputMode("update")
        .foreachBatch(add)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    every = spark.read.schema(CHANGE).parquet(counters)
    return every.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def _steps() -> str:
    """Every order and step: its filter, and the filters before it, as masks."""
    bits = dict(zip(FILTERS, (A, B, C, D, E)))
    return json.dumps(
        [
            {"filter_order": "".join(order), "step": k + 1, "bit": bits[order[k]], "before": sum(bits[f] for f in order[:k])}
            for order in permutations(FILTERS)
            for k in range(len(FILTERS))
        ]
    )


def all_orders(counters: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts of each; a row for every order and step of every part."""
    cells = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order:string,step:int,bit:int,before:int>>")
    placed = cells.select("part", "mask", "n", "good", "toxic", F.inline(steps))
    mask, bit = F.col("mask"), F.col("bit")
    fails = mask.bitwiseAND(bit) != 0
    gone = mask.bitwiseAND(F.col("before")) != 0
    # A document that fails k filters is removed by each of them in 120 / k of the orders.
    orders = F.call_function("div", F.lit(120), F.greatest(F.bit_count("mask"), F.lit(1)))

    def total(when, what: str | None = None):
        return F.sum(F.when(when, F.col(what or "n")).otherwise(F.lit(0).cast("bigint")))

    return placed.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * orders).otherwise(F.lit(0).cast("bigint"))).alias("shapley"),
    )


def audit_filters(spark: SparkSession, path: str, labels: DataFrame, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """The counts of every part, order and step over the documents (doc_id, lang, text) stored under `path`."""
    return all_orders(count_documents(spark, path, labels, micro_batches))
