"""Suffix-array dedup: repeated byte strings by a depth-limited radix sort of sampled suffixes.

Suffixes need order only through `LENGTH` bytes: suffixes that agree so far are the repeated windows. Not
every suffix is sorted. A window (LENGTH bytes) is represented by the suffix at its anchor, the leftmost
least hash of `GRAM` bytes among its first `REACH` starts: equal windows have their anchors at equal
places. Consecutive windows with one anchor are one row, so about 2 in REACH suffixes remain.

The sort goes by most significant digits, each pass on what the one before left:

1. the bytes that follow the anchor in every window it can stand for; a value that occurs once ends here;
2. all bytes of the anchor's windows; where a value occurs again, all these windows are repeated;
3. for the rest, which lie at the borders of repeats, the windows one by one, compared with each other
   and with one representative of each value of pass 2. Groups of up to `GROUP` anchors are compared in
   one task; windows of larger groups are counted by Spark.

Equal texts of LENGTH bytes or more repeat as a whole; this is read off a count of their digests. Digests
have 64 bits and go with the size of the text or, for windows, with the value of the first pass.

Defined results: texts are UTF-8 bytes, NULL is empty; texts shorter than LENGTH keep everything; a text
that is removed as a whole keeps the empty string; repeated rows are occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm import common

LENGTH, REACH, GRAM = 400, 200, 16
GROUP = 20_000

_PLACE = np.uint64((1 << 28) - 1)
_SETTLED, _OPEN, _MODEL, _COPIED = range(4)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, reach: int) -> tuple[np.ndarray, ...]:
    """Texts, anchors, first and last windows, and the digits of passes 1 and 2; all but the texts as places in the data."""
    prefix = common.prefix_hashes(data)
    starts = np.arange(max(0, len(data) - GRAM + 1))
    value = common.span_hashes(prefix, starts, starts + GRAM)
    value = (value & ~_PLACE) | starts.astype(np.uint64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.maximum(np.diff(offsets) - length + 1, 0))
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    window = offsets[:-1][doc] + np.arange(len(doc)) - np.concatenate(([0], np.cumsum(counts)))[:-1][doc]
    if not len(window):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    width = 1
    while width * 2 <= reach:
        value = np.minimum(value[:-width], value[width:])
        width *= 2
    if width < reach:
        value = np.minimum(value[: width - reach], value[reach - width :])
    anchor = (value[window] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.append(first[1:], len(window)) - 1
    doc, anchor, low, high = doc[first], anchor[first], window[first], window[last]
    digit = common.span_hashes(prefix, anchor, anchor + length - reach + 1)
    whole = common.span_hashes(prefix, low, high + length)
    return doc, anchor, low, high, digit, common.mixed(whole + (anchor - low).astype(np.uint64))


def _anchor_rows(length: int, reach: int, all_columns: bool):
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            data, offsets = common.utf8(part.column("text"))
            doc, _, low, high, digit, whole = anchors(data, offsets, length, reach)
            digit = pa.array(digit.view(np.int64))
            if not all_columns:
                yield pa.RecordBatch.from_arrays([digit], ["digit"])
                continue
            key, size = part.column("key").to_numpy()[doc], part.column("size").to_numpy()[doc]
            low, high = low - offsets[doc], high - offsets[doc]
            columns = [digit, *map(pa.array, (whole.view(np.int64), key, size, low, high))]
            yield pa.RecordBatch.from_arrays(columns, ["digit", "whole", "key", "size", "low", "high"])

    return of


def merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of the ranges [low, high)."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    first = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1]))) if len(low) else np.zeros(0, np.int64)
    return low[first], high[np.append(first[1:], len(low)) - 1] if len(low) else high


def _cut(text: bytes, low: np.ndarray, high: np.ndarray) -> dict:
    """What remains of a text without the given runs."""
    at, digest = 0, hashlib.sha256()
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        digest.update(text[at:a])
        at = b
    digest.update(text[at:])
    return {"n_removed": int((high - low).sum()), "n_spans": len(low), "kept_sha256": digest.hexdigest()}


def _runs_text(low: np.ndarray, high: np.ndarray) -> bytes:
    return np.column_stack([low, high]).astype(np.int64).tobytes()


_CUT = "doc_id {kind}, key long, size long, n_removed long, n_spans long, kept_sha256 string, runs binary"
_NOTE = "array<struct<low: long, high: long, flag: int, digit: long>>"


def _settle(length: int, schema: pa.Schema):
    """Cut texts whose windows are all decided; keep the text of those that have open windows or serve as models."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            out = []
            columns = [part.column(c).to_pylist() for c in ("doc_id", "key", "size", "text", "notes")]
            for doc_id, key, size, text, notes in zip(*columns, strict=True):
                raw, notes = (text or "").encode(), notes or []
                flags = {n["flag"] for n in notes}
                row = {"doc_id": doc_id, "key": key, "size": size, "text": None, "notes": None}
                if _COPIED in flags and size >= length:
                    low, high = np.zeros(1, np.int64), np.full(1, size)
                else:
                    own = [n for n in notes if n["flag"] == _SETTLED]
                    low = np.array([n["low"] for n in own], np.int64)
                    low, high = merged(low, np.array([n["high"] + length for n in own], np.int64))
                whole = _COPIED in flags and size >= length
                open_ = _OPEN in flags and not whole
                row |= {"n_removed": None, "n_spans": None, "kept_sha256": None} if open_ else _cut(raw, low, high)
                row["runs"], row["open"] = _runs_text(low, high), open_
                if open_ or _MODEL in flags:
                    row["text"] = text
                    row["notes"] = [n for n in notes if n["flag"] == _MODEL or n["flag"] == _OPEN and not whole]
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema)

    return of


def _contexts(length: int):
    """The bytes of all windows of the open anchors and the models."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            out: dict[str, list] = {c: [] for c in ("digit", "key", "size", "low", "is_open", "context")}
            for key, size, text, notes in zip(*(part.column(c).to_pylist() for c in ("key", "size", "text", "notes")), strict=True):
                raw = text.encode()
                for n in notes:
                    for c, v in (("digit", n["digit"]), ("key", key), ("size", size), ("low", n["low"])):
                        out[c].append(v)
                    out["is_open"].append(n["flag"] == _OPEN)
                    out["context"].append(raw[n["low"] : n["high"] + length])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))

    return of


def _windows(rows: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, places in the text and digests of all windows of the contexts."""
    contexts = rows.column("context").to_pylist()
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    begins = np.concatenate(([0], np.cumsum(sizes)))
    counts = sizes - length + 1
    row = np.repeat(np.arange(len(contexts)), counts)
    step = np.arange(len(row)) - np.concatenate(([0], np.cumsum(counts)))[:-1][row]
    start = begins[:-1][row] + step
    digest = common.span_hashes(common.prefix_hashes(np.frombuffer(b"".join(contexts), np.uint8)), start, start + length)
    digit = rows.column("digit").to_numpy().view(np.uint64)[row]
    return row, rows.column("low").to_numpy()[row] + step, common.mixed(digest ^ common.mixed(digit))


def _compared(length: int):
    """Runs of the open windows that occur again in their group."""

    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in common.key_groups(batches, ["digit"]):
            row, place, digest = _windows(rows, length)
            _, at, count = np.unique(digest, return_inverse=True, return_counts=True)
            hit = (count[at] > 1) & rows.column("is_open").to_numpy(zero_copy_only=False)[row]
            row, place = row[hit], place[hit]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1))) if len(row) else hit[:0]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(row)) - 1 if len(first) else first
            key, size = (rows.column(c).to_numpy()[row[first]] for c in ("key", "size"))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (key, size, place[first], place[last] + length))), ["key", "size", "low", "high"])

    return of


def _window_rows(length: int):
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                row, place, digest = _windows(part, length)
                key, size, is_open = (part.column(c).to_numpy(zero_copy_only=False)[row] for c in ("key", "size", "is_open"))
                columns = [digest.view(np.int64), part.column("digit").to_numpy()[row], key, size, is_open, place]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["window", "digit", "key", "size", "is_open", "low"])

    return of


def _finish(schema: pa.Schema):
    def of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.slices(batches):
            out = []
            columns = [part.column(c).to_pylist() for c in ("doc_id", "key", "size", "text", "runs", "hits")]
            for doc_id, key, size, text, runs, hits in zip(*columns, strict=True):
                settled = np.frombuffer(runs, np.int64).reshape(-1, 2)
                found = np.array([(h["low"], h["high"]) for h in hits or []], np.int64).reshape(-1, 2)
                low, high = merged(*np.concatenate([settled, found]).T)
                row = {"doc_id": doc_id, "key": key, "size": size, "runs": _runs_text(low, high)}
                out.append(row | _cut(text.encode(), low, high))
            yield pa.RecordBatch.from_pylist(out, schema)

    return of


def deduplicated(docs: DataFrame, length: int = LENGTH, reach: int = REACH, group: int = GROUP) -> DataFrame:
    """doc_id, size, n_removed, n_spans, kept_sha256 and runs, the removed [low, high) as pairs of 64-bit integers."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"), F.octet_length(text).cast("long").alias("size"))
    long = texts.filter(F.col("size") >= length)

    digits = long.select("text").mapInArrow(_anchor_rows(length, reach, False), "digit long")
    again = digits.groupBy("digit").agg(F.count("*").alias("n")).filter("n > 1").select("digit")
    again = common.staged(again)  # both sides of the join then come from plain shuffles, which skew join can split
    schema = "digit long, whole long, key long, size long, low long, high long"
    rows = long.select("text", "key", "size").mapInArrow(_anchor_rows(length, reach, True), schema)
    # grouped by the row as a whole: copies are reduced before they shuffle by it, and the join can be split at a hot digit
    rows = rows.join(again.hint("merge"), "digit").groupBy(F.struct("digit", "whole", "key", "size", "low", "high").alias("row"))
    rows = common.staged(rows.agg(F.count("*").alias("n")).select("row.*", "n"))
    wholes = rows.groupBy("digit", "whole").agg(F.sum("n").alias("all"), F.min(F.struct("key", "size", "low", "high")).alias("model"))
    wholes = common.staged(wholes)
    single = wholes.filter("all = 1").select("digit", "whole")
    settled = rows.join(single, ["digit", "whole"], "left_anti").withColumn("flag", F.lit(_SETTLED))
    open_ = rows.join(single, ["digit", "whole"], "left_semi").withColumn("flag", F.lit(_OPEN))
    models = wholes.filter("all > 1").join(single.select("digit").distinct(), "digit", "left_semi")
    models = models.select("digit", "model.*", F.lit(_MODEL).alias("flag"))
    copied = long.groupBy("key", "size").agg(F.count("*").alias("n")).filter("n > 1")
    copied = copied.select("key", "size", *(F.lit(0).cast("long").alias(c) for c in ("low", "high", "digit")), F.lit(_COPIED).alias("flag"))
    columns = ["key", "size", "low", "high", "flag", "digit"]
    notes = settled.select(columns).union(open_.select(columns)).union(models.select(columns)).union(copied.select(columns))
    notes = notes.groupBy("key", "size").agg(F.collect_list(F.struct("low", "high", "flag", "digit")).alias("notes"))

    cut = docs.sparkSession.createDataFrame([], _CUT.format(kind=kind)).schema
    kept = docs.sparkSession.createDataFrame([], f"{_CUT.format(kind=kind)}, text string, notes {_NOTE}, open boolean").schema
    noted = texts.join(notes.hint("merge"), ["key", "size"], "left").select("doc_id", "key", "size", "text", "notes")
    first = common.staged(noted.mapInArrow(_settle(length, to_arrow_schema(kept)), kept))

    context = "digit long, key long, size long, low long, is_open boolean, context binary"
    contexts = first.filter("text is not null").select("key", "size", "text", "notes").mapInArrow(_contexts(length), context)
    contexts = contexts.groupBy("digit", "key", "size", "low", "is_open").agg(F.first("context").alias("context"))
    contexts = common.staged(contexts)
    large = contexts.groupBy("digit").agg(F.count("*").alias("n")).filter(F.col("n") > group).select("digit")
    small = contexts.join(large, "digit", "left_anti").repartition("digit").sortWithinPartitions("digit")
    hits = small.mapInArrow(_compared(length), "key long, size long, low long, high long")
    schema = "window long, digit long, key long, size long, is_open boolean, low long"
    single_windows = contexts.join(large, "digit", "left_semi").mapInArrow(_window_rows(length), schema)
    several = single_windows.groupBy("window", "digit").agg(F.count("*").alias("n")).filter("n > 1").select("window", "digit")
    more = single_windows.filter("is_open").join(several, ["window", "digit"], "left_semi")
    hits = hits.union(more.select("key", "size", "low", F.col("low") + length))
    hits = hits.groupBy("key", "size").agg(F.collect_list(F.struct("low", "high")).alias("hits"))
    rest = first.filter("open").select("doc_id", "key", "size", "text", "runs").join(hits.hint("merge"), ["key", "size"], "left")
    rest = rest.select("doc_id", "key", "size", "text", "runs", "hits").mapInArrow(_finish(to_arrow_schema(cut)), cut)
    return first.filter("not open").select(rest.columns).union(rest).drop("key")
