"""Secret scan with multipart credential linking.

Strong findings stand by themselves: assignments to a secret's name, access key ids and long hexadecimal strings.
Weak candidates are parts of a credential that mean little alone: a token of mixed characters (a secret), an
assignment to a user or client name (an identifier), a URL or host with a port (an endpoint).  They are reported
only where complementary parts stand within ``SCOPE`` characters: a weak secret beside an identifier, a weak
identifier or an endpoint beside parts of both other kinds.

The texts are scanned where they lie; only the spans found travel.  The interval join runs on (document, bin of
SCOPE characters): the parts that touch a bin fold into their least start and greatest stop, and whether a part lies
within SCOPE of a candidate follows from those of the bins that the candidate with SCOPE on either side touches, so
no pairs of parts are made.  That reach is longer than a bin: of its inner bins every part is near, in its first bin
those that stop late enough, in its last bin those that start early enough.
"""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, stored

SCOPE = 300
#: Kinds in the order in which spans of one start are listed; the first three are strong.
KINDS = ["assign", "access", "hex", "secret", "identifier", "endpoint"]
PART = {"assign": "S", "access": "I", "hex": "S", "secret": "S", "identifier": "I", "endpoint": "E"}

_ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_NAME = re.compile(r"(?i:user_?name|user|login|client_?id|account_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@_.-]{3,}", re.ASCII)
_PLACE = re.compile(r"(?i:https?|ftp|ssh|s3|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|"
                    r"\b(?:[a-z0-9-]+\.)+[a-z]{2,}:[0-9]{2,5}\b", re.ASCII)


_PORT = re.compile(r"[a-z]:[0-9]{2}")


def _strong(text: str, low: str):
    if any(k in low for k in ("passw", "secret", "token", "api")):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 8:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if m.end() - m.start() >= 16:
                yield 1, m.start(), m.end()
    for m in _HEX.finditer(text):
        yield 2, m.start(), m.end()


def _weak(text: str, low: str, identified: bool):
    """No weak candidate counts without an identifier, so a text that has none is not searched for the rest."""
    names = []
    if any(k in low for k in ("user", "login", "client", "account")):
        names = [(4, m.start(), m.end()) for m in _NAME.finditer(text)]
    if not names and not identified:
        return
    yield from names
    for m in _TOKEN.finditer(text):
        own = m[0]
        if any(c.isdigit() for c in own) and any(c.isupper() for c in own) and any(c.islower() for c in own):
            yield 3, m.start(), m.end()
    if "://" in text or _PORT.search(text):
        for m in _PLACE.finditer(text):
            yield 5, m.start(), m.end()


def scan(text: str | None) -> list[tuple[int, int, int]]:
    """The spans (kind, start, end) in code points, by start and kind; weak candidates that touch a strong one are left out."""
    if not text:
        return []
    low = text.lower()
    strong = sorted(_strong(text, low), key=lambda s: (s[1], s[0]))
    out, at, reach = list(strong), 0, -1
    for w in sorted(_weak(text, low, any(k == 1 for k, _, _ in strong)), key=lambda s: (s[1], s[0])):
        while at < len(strong) and strong[at][1] < w[2]:
            reach = max(reach, strong[at][2])
            at += 1
        if reach <= w[1]:
            out.append(w)
    return sorted(out, key=lambda s: (s[1], s[0]))


_SPAN = "struct<start:int,kind:int,stop:int>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``: array of (start, kind, stop), sorted; ``kind`` counts :data:`KINDS`.

    Strong spans are all there; weak ones only with their complements in scope.  Null and empty texts have none.
    ``scope`` counts the characters between the end of the one span and the start of the other (0 if they touch or
    overlap), so that the spans' own lengths do not part them.
    Repeated rows are reported each; a null id is an id like any other; other columns are not read."""
    def run(frames):
        for b in batches_of(frames):
            spans = [[{"start": s, "kind": k, "stop": e} for k, s, e in scan(t)] for t in b.column(2).to_pylist()]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(spans, kind)], names=["doc_id", "key", "spans"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    found = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text")) \
        .mapInArrow(run, f"doc_id {id_kind}, key long, spans array<{_SPAN}>")
    found = stored(found, "spans")

    # rows of one id and text have the same spans: one stands for all
    doc = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "key")
    linked = found.where(F.exists("spans", lambda s: s["kind"] >= 3)).withColumn("doc", doc)
    linked = linked.select("doc", "key", F.explode("spans").alias("s")).distinct()
    parts = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (k, PART[name])])
    start, stop = F.col("s.start"), F.col("s.stop")
    bins = lambda low, high: F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope))).alias("bin")
    each = linked.select("doc", "key", "s", F.element_at(parts, F.col("s.kind")).alias("part"))
    place = each.select("doc", "key", "part", start.alias("start"), stop.alias("stop"), bins(start, stop)) \
        .groupBy("doc", "key", "bin", "part").agg(F.min("start").alias("first"), F.max("stop").alias("last"))
    weak = each.where("s.kind >= 3").select("doc", "key", "s", F.col("part").alias("own"), bins(start - scope, stop + scope))
    near = (F.col("first") <= stop + scope) & (F.col("last") >= start - scope)
    seen = weak.join(place, ["doc", "key", "bin"]).where((F.col("part") != F.col("own")) & near) \
        .groupBy("doc", "key", "s", "own").agg(*[F.max(F.col("part") == p).alias(f"by_{p}") for p in "ISE"])
    needed = F.when(F.col("s.kind") == KINDS.index("secret"), F.col("by_I")) \
        .when(F.col("s.kind") == KINDS.index("identifier"), F.col("by_S") & F.col("by_E")).otherwise(F.col("by_I") & F.col("by_S"))
    told = seen.where(needed).groupBy("doc", "key").agg(F.collect_set("s").alias("more"))
    out = found.withColumn("doc", doc).join(stored(told, "linked"), ["doc", "key"], "left")
    strong = F.filter("spans", lambda s: s["kind"] < 3)
    return out.select("doc_id", F.sort_array(F.concat(strong, F.coalesce("more", F.array().cast(f"array<{_SPAN}>")))).alias("spans"))


def listed(spans):
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"),
                                                                 s["stop"].cast("string"))), ",")
