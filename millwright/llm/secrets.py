"""Secret scan with multipart credential linking.

Strong findings stand on their own: an assignment to a secret's name, a cloud
access key, a long run of hexadecimal digits.  Weak parts do not: a short
access identifier or user name, a random-looking token, a service endpoint.
A weak part is reported only if a complementary part (identifier with secret,
secret with endpoint or identifier) lies within its scope, found by an
interval join of the parts of a document.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_KEY, cut_lineage, with_row_key

#: Code points between the ends of parts that belong together.
SCOPE = 200
#: Bits per character from which a token counts as random.
MIN_ENTROPY = 3.5

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WEAK_ID = re.compile(
    r"""(?ai:\b(?:user(?:name)?|login|client_?id|access_?(?:key_?)?id|account)["']?\x20*[:=]\x20*["']?([\w.@-]{3,}))"""
    r"""|\b(?:AKIA|ASIA)[A-Z0-9]{8,}""")
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{16,}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(
    r"(?a:\b(?:https?|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\s\"'<>]+|\b\d{1,3}(?:\.\d{1,3}){3}:\d{2,5}\b)")

#: Roles of parts, and which roles complete one another.
ROLES = ("identifier", "secret", "endpoint")
_SPAN = "struct<kind:string,start:int,end:int>"
_PART = "struct<role:string,weak:boolean,start:int,end:int>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Strong findings, by start and then kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def entropy(token: str) -> float:
    counts = Counter(token)
    return -sum(c / len(token) * math.log2(c / len(token)) for c in counts.values())


def _random_looking(token: str) -> bool:
    """Digits and letters of both cases mixed, with high entropy (words and paths are not)."""
    return (any(c.isdigit() for c in token) and any(c.isupper() for c in token)
            and any(c.islower() for c in token) and entropy(token) >= MIN_ENTROPY)


def parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, bool, int, int]]:
    """Credential parts (role, weak, start, end): strong findings and weak candidates that none of them covers."""
    out = [("identifier" if k == "access" else "secret", False, i, j) for k, i, j in base]
    starts = [i for _, i, _ in base]  # in order
    reach = list(accumulate((j for _, _, j in base), max))  # how far the spans up to each one go
    taken = 0  # how far the weak parts taken so far go; they are met by start

    def free(i: int, j: int) -> bool:
        before = bisect_left(starts, j)  # spans that begin before the end
        return taken <= i and (not before or reach[before - 1] <= i)

    weak = [("identifier", m.start(), m.end()) for m in _WEAK_ID.finditer(text)]
    weak += [("endpoint", m.start(), m.end()) for m in _ENDPOINT.finditer(text)]
    weak += [("secret", m.start(), m.end()) for m in _WEAK_SECRET.finditer(text) if _random_looking(m[0])]
    for role, i, j in sorted(weak, key=lambda s: (s[1], s[2], ROLES.index(s[0]))):
        if free(i, j):
            out.append((role, True, i, j))
            if role != "endpoint":
                taken = max(taken, j)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(id_col, base, linked): strong spans and the weak spans that complementary parts support.

    Both are arrays of (kind, start, end) in code points, end exclusive, by
    start.  Null and empty texts have empty arrays; repeated rows and equal or
    null ids stay as rows of their own; other columns are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    keyed = with_row_key(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["id", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        part = pa.list_(pa.struct([("role", pa.string()), ("weak", pa.bool_()), ("start", pa.int32()), ("end", pa.int32())]))
        for b in batches:
            found, loose = [], []
            for text in b.column(2).to_pylist():
                base = base_spans(text or "")
                got = parts(text or "", base)
                found.append([dict(zip(("kind", "start", "end"), s)) for s in base])
                weak = any(p[1] for p in got) and len({p[0] for p in got}) > 1
                loose.append([dict(zip(("role", "weak", "start", "end"), p)) for p in got] if weak else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, span), pa.array(loose, part)],
                                             [ROW_KEY, "id", "base", "parts"])

    scanned = cut_lineage(keyed.mapInArrow(run, f"{ROW_KEY} long, id {id_type}, base array<{_SPAN}>, parts array<{_PART}>"))
    linked = link(scanned.select(ROW_KEY, F.explode("parts").alias("p")).select(ROW_KEY, "p.*"), scope)
    spans = linked.groupBy(ROW_KEY).agg(F.sort_array(F.collect_set(F.struct("start", "end", "kind"))).alias("linked"))
    none = F.array().cast(f"array<{_SPAN}>")
    return scanned.join(spans, ROW_KEY, "left").select(
        F.col("id").alias(id_col), "base",
        F.coalesce(F.transform("linked", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                                                            s["end"].alias("end"))), none).alias("linked"))


def link(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(row key, kind, start, end) of weak parts with a complementary part at most ``scope`` code points away.

    An interval join on (document, stretch of the text): a part is listed in
    every stretch that it or its scope touches, a weak part looks in the
    stretches that it touches itself.  What a stretch holds is bounded by its length,
    so a document of any length is many small keys.
    """
    stretch = 4 * scope
    at = lambda c: F.floor(c / stretch)
    near = found.select(ROW_KEY, "role", "start", "end", F.explode(F.sequence(
        at(F.greatest(F.col("start") - scope, F.lit(0))), at(F.col("end") + scope))).alias("stretch"))
    weak = found.where("weak").select(ROW_KEY, F.col("role").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
                                      F.explode(F.sequence(at(F.col("start")), at(F.col("end")))).alias("stretch"))
    hits = weak.join(near, [ROW_KEY, "stretch"]).where(
        (F.col("r") != F.col("role")) & (F.col("start") - F.col("e") <= scope) & (F.col("s") - F.col("end") <= scope)
        & ((F.col("r") == "secret") | (F.col("role") == "secret")))
    return hits.select(ROW_KEY, F.concat(F.lit("weak_"), "r").alias("kind"), F.col("s").alias("start"),
                       F.col("e").alias("end")).distinct()
