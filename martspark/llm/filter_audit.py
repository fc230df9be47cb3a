"""Audit of how quality filters interact, over every order in which they can run.

Each document has a mask of the filters that it fails. A mask matrix holds 0
where a filter fails and infinity where it doesn't; a position matrix holds each
filter's place in each order (the order's inverse permutation). Their min-plus
product is the step at which a document is removed. Documents with one
mask are alike, so the product runs over masks, weighted with how many
documents of a part have them; scattered by removal step, the weights give what
every step keeps and removes, and what later filters would have removed again.

Masks are made in one pass over the texts; only ids, masks and text hashes (SHA-256)
are shuffled. Copies are counted per text before they meet, so an often
repeated text or id takes no more room in a task than a rare one.

Defined results: a null text is empty, so it is a copy of empty ones. Rows with
a null id are never copies and make no others copies; rows of one id with one
text are not copies of each other. A null part is ''. An id labelled more than
once has each label that any of its rows has; null labels and ids count as
none. Whole texts are read, also very long ones. Of the input's columns only
those named are read, so others can have any name. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martspark.llm.common import as_bytes, per_batch

#: FIXED VALUES of the query's filters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
MARKS = re.compile(rb"[#$%&*|]")
_NO_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUING = bytes(range(0x80, 0xC0))


def few_words(text: bytes, words: list[bytes]) -> bool:
    return len(words) < LEAST_WORDS


def repetitive(text: bytes, words: list[bytes]) -> bool:
    return 100 * len(set(words)) < LEAST_DISTINCT * len(words)


def capitals(text: bytes, words: list[bytes]) -> bool:
    """Of UTF-8, code points are the bytes that don't continue one."""
    return 100 * (len(text) - len(text.translate(None, _NO_CAPITALS))) > MOST_CAPITALS * len(text.translate(None, _CONTINUING))


def marked(text: bytes, words: list[bytes]) -> bool:
    return bool(MARKS.search(text))


#: Tests of one text, by letter: true where it fails. Words are the text's, split at ASCII white space.
TESTS: dict[str, Callable[[bytes, list[bytes]], bool]] = {"A": few_words, "B": repetitive, "C": capitals, "D": marked}
#: The letter of the filter that removes copies of a smaller id's text.
COPY = "E"


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Step (from 0) at which each mask is removed under each order, infinity if never: the min-plus product.

    masks (masks, filters) is true where a filter fails; places (orders, filters) is each filter's step.
    """
    cost = np.where(masks, 0.0, np.inf)
    steps = np.full((len(masks), len(places)), np.inf)
    for f in range(masks.shape[1]):  # one filter at a time: the sum over all three never stands whole
        np.minimum(steps, cost[:, f, None] + places[None, :, f], out=steps)
    return steps


def audit_masks(fails: np.ndarray, weights: np.ndarray, letters: str) -> dict[str, np.ndarray | list]:
    """Counts for every order and step. fails: one bit mask a row; weights (rows, 3): documents, good and toxic ones."""
    k = len(letters)
    orders = np.array(list(permutations(range(k))))
    places = np.argsort(orders, axis=1)
    masks = (fails[:, None] >> np.arange(k) & 1).astype(bool)
    steps = removal_steps(masks, places)
    n, total = weights[:, 0], int(weights[:, 0].sum())
    row, order = np.nonzero(np.isfinite(steps))
    removed = np.zeros((len(orders), k, 3), np.int64)
    np.add.at(removed, (order, steps[row, order].astype(int)), weights[row])
    failing = np.array([n[masks[:, f]].sum() for f in range(k)], np.int64)
    alone = np.array([n[masks[:, f] & (masks.sum(axis=1) == 1)].sum() for f in range(k)], np.int64)
    here = removed[:, :, 0]
    shapley = np.zeros(k, np.int64)
    np.add.at(shapley, orders, here)
    return {
        "filter_order": ["".join(letters[f] for f in o) for o in orders for _ in range(k)],
        "step": np.tile(np.arange(1, k + 1), len(orders)),
        "kept": (total - np.cumsum(here, axis=1)).ravel(),
        "removed": here.ravel(),
        # A filter's failing documents are all gone after its step: those not removed here were removed earlier.
        "redundant": (failing[orders] - here).ravel(),
        "unique_fails": alone[orders].ravel(),
        "good_lost": removed[:, :, 1].ravel(),
        "toxic_lost": removed[:, :, 2].ravel(),
        "shapley": shapley[orders].ravel(),
    }


def tested(docs: DataFrame, part: str, tests: dict[str, Callable]) -> DataFrame:
    """doc_id, part, fails (bit i for the i-th test) and the text's SHA-256 of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("fails", pa.int32()), ("digest", pa.binary())])

    def of_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(2))
        fails = []
        for text in texts:
            words = text.split()
            fails.append(sum(test(text, words) << i for i, test in enumerate(tests.values())))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()).fill_null(""), pa.array(fails, pa.int32()),
                                           pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())], schema=schema)

    return docs.select("doc_id", F.col(part).cast("string"), "text").mapInArrow(per_batch(of_batch), "doc_id long, part string, fails int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang", tests: dict[str, Callable] = TESTS) -> DataFrame:
    """part, fails, and its documents: n, n_good (quality 1), n_toxic (toxic 1). The last bit is the copies'."""
    known = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).where("doc_id is not null")
    # Repeated rows are added up first; nothing after the join needs its partitioning, so a hot id can be split there.
    rows = tested(docs, part, tests).groupBy("doc_id", "digest", "part", "fails").agg(F.count("*").alias("n"))
    ids = rows.join(known, "doc_id", "left").select("doc_id", "digest", "part", "fails", "n", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")))
    kind = ["digest", "part", "fails", "good", "toxic"]
    named = F.col("doc_id").isNotNull()
    texts = ids.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum(F.when(named, F.col("n"))).alias("named"), F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"))
    least = texts.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    # Of a text's rows with an id, those of its smallest id are no copies.
    copies = F.coalesce(F.col("named") - F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0), F.lit(0))
    split = texts.join(least, "digest").select(*kind, "n", copies.alias("copies")).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct(F.col("fails"), (F.col("n") - F.col("copies")).alias("n")),
            F.struct(F.col("fails").bitwiseOR(1 << len(tests)).alias("fails"), F.col("copies").alias("n")))).alias("m"))
    return split.where("m.n > 0").groupBy("part", F.col("m.fails").alias("fails")).agg(
        F.sum("m.n").alias("n"), F.sum(F.col("m.n") * F.col("good")).alias("n_good"), F.sum(F.col("m.n") * F.col("toxic")).alias("n_toxic"))


SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", tests: dict[str, Callable] = TESTS) -> DataFrame:
    """One row per part, order of the filters and step. Input: doc_id, text and the part's column; doc_id, quality, toxic."""
    letters = "".join(tests) + COPY
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def of_part(masks: pa.Table) -> pa.Table:
        found = audit_masks(masks["fails"].to_numpy(), np.column_stack([masks[c].to_numpy() for c in ("n", "n_good", "n_toxic")]), letters)
        found["part"] = [masks["part"][0].as_py()] * len(found["step"])
        types: Sequence[pa.DataType] = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.Table.from_arrays([pa.array(found[c], t) for c, t in zip(names, types)], names=names)

    return mask_counts(docs, labels, part, tests).groupBy("part").applyInArrow(of_part, SCHEMA)
