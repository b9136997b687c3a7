"""Helpers shared by the training-data operators."""
from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import store

#: A word is a longest run of characters other than space, tab, line feed, vertical tab, form feed, return.
#: These are also the separators of ``bytes.split()``, so Python and Spark cut the same words.
WORD_GAP = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_GAP = re.compile(rb"[\x20\x09-\x0d]")
_BLOCK_BYTES = 1 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once, in a fresh table of the shared checkpoint folder (see :func:`playledger.session.store`)."""
    return store(df, f"llm-{name}")


#: Rows, and bytes of their texts, up to which keys are sent to every task.
SEND_KEYS, SEND_KEY_BYTES = 400_000, 40 << 20


def sent(keys: DataFrame) -> DataFrame:
    """``keys`` (a stored frame) with a broadcast hint if they are few, by rows and by the length of their texts."""
    texts = [F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in keys.schema.fields
             if f.dataType.typeName() in ("string", "struct")]
    size = keys.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0)).alias("b")).first()
    return F.broadcast(keys) if size.n <= SEND_KEYS and size.b <= SEND_KEY_BYTES else keys


def rows_in(docs: DataFrame, keys: DataFrame, made: dict[str, Callable], how: str = "left_semi", once: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, whose key is in ``keys`` (or, with "left_anti", is not); null equals null.

    ``made``: for each column of ``keys`` a function from a column getter of ``docs`` to the key's expression.  Columns
    of ``docs`` may have any names.  ``once``: one row for each key only.  With "left_anti" the keys, which are then stored
    ones, are sent to all tasks if they are few, and no text is shuffled: so let ``keys`` be those of the rows to drop."""
    own = [f"_c{k}" for k in range(len(docs.columns))]
    keys = keys.select(*made)
    named = docs.toDF(*own).withColumns({f"_m_{k}": f(lambda c: F.col(own[docs.columns.index(c)])) for k, f in made.items()})
    right = sent(keys).select(*[F.col(k).alias(f"_r_{k}") for k in made]) if how == "left_anti" else \
        keys.select(*[F.col(k).alias(f"_r_{k}") for k in made]).distinct()
    cond = reduce(Column.__and__, [F.col(f"_m_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in made])
    out = named.join(right, cond, how)
    if once:
        out = out.dropDuplicates([f"_m_{k}" for k in made])
    return out.select(*own).toDF(*docs.columns)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of ``text`` in order; null has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def fold(docs: DataFrame, remainder: int, modulus: int, id_col: str = "doc_id") -> Column:
    """True for the documents whose crc32 of the id's decimal text leaves ``remainder``; a null id is in no fold."""
    return F.coalesce(F.crc32(docs[id_col].cast("string")) % modulus == remainder, F.lit(False))


def word_blocks(data: bytes, overlap: int):
    """Yield lists of the words of ``data``; each list but the first repeats the last ``overlap`` words before it.

    A text is cut at word gaps after about a megabyte, so that the word lists of a very long text stay small.
    A block that brings no new word is not yielded; a text without words yields nothing."""
    pos, tail = 0, []
    while pos < len(data):
        cut = len(data)
        if cut - pos > _BLOCK_BYTES:
            gap = _GAP.search(data, pos + _BLOCK_BYTES)
            cut = gap.start() if gap else cut
        new = data[pos:cut].split()
        pos = cut
        if new:
            block = tail + new
            yield block
            tail = block[-overlap:] if overlap else []


def line_blocks(data: bytes):
    """Yield lists of the lines of ``data``; a long text is cut at line ends after about a megabyte."""
    pos = 0
    while pos < len(data):
        cut = data.find(b"\n", pos + _BLOCK_BYTES)
        cut = len(data) if cut < 0 else cut
        yield data[pos:cut].split(b"\n")
        pos = cut + 1


def batches_of(frames, rows: int = 512):
    """Re-slice Arrow batches to at most ``rows`` rows, so that one batch's Python objects stay small."""
    for b in frames:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def per_worker(key, make):
    """``make()``, once for each Python worker process and ``key``; tasks that reuse the worker share the object."""
    import sys
    import types
    kept = sys.modules.setdefault("_llm_worker_objects", types.ModuleType("_llm_worker_objects")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
