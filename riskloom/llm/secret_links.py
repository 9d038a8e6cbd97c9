"""Secret scan with linking of multipart credentials.

Base patterns are reported wherever they match. Weak candidates (identifiers, secrets and endpoints that look like ordinary text on
their own) are reported only together: a scope is a paragraph, and a candidate is reported if the roles it needs occur in its scope,
however far away. The roles of each scope are aggregated first and joined back, so no pairs are put out. Patterns run to the end of
what they match; none has an upper length.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import fresh, in_blocks, ship
from riskloom.session import settle

# Base kinds in the order they are listed: pattern, the group whose length counts, its least length. Fixed values.
BASE: tuple[tuple[str, re.Pattern, int, int], ...] = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: Runs of the hex pattern below the least length are dropped, so they need not be visited; a run is matched whole either way.
HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: Weak kinds: pattern and role. A secret must hold upper and lower case and a digit.
WEAK: tuple[tuple[str, re.Pattern, str], ...] = (
    ("ident", re.compile(r"(?<![A-Za-z0-9_])ASIA[A-Z0-9]{16,}|(?i:client_?id|access_?id|account_?name|account|user_?name|user|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}", re.A), "id"),
    ("part", re.compile(r"(?<![A-Za-z0-9+/])(?=[A-Za-z0-9+/]*[A-Z])(?=[A-Za-z0-9+/]*[a-z])(?=[A-Za-z0-9+/]*[0-9])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=])", re.A), "secret"),
    ("endpoint", re.compile(r"(?:https?|s3|jdbc:[a-z]+|amqps?|redis|mongodb|postgres(?:ql)?|mysql)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}", re.A), "endpoint"),
)
KINDS = [k for k, *_ in BASE] + [k for k, *_ in WEAK]
ROLE = {"assign": "secret", "access": "id", "hex": "secret"} | {k: role for k, _, role in WEAK}
#: The roles that must occur in its scope for a weak candidate to be reported.
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
BREAK = re.compile(r"\n[^\S\n]*\n")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base matches, by start, then kind as listed; code points, end exclusive."""
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        for m in (HEX_LONG if kind == "hex" else pattern).finditer(text):
            if len(m.group(group)) >= least:
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Weak candidates that do not overlap a base match of their own role."""
    found = []
    for kind, pattern, role in WEAK:
        own = [(a, b) for k, a, b in base if ROLE[k] == role]
        # Of matches by start, one's end may lie beyond the next one's: the furthest end so far decides.
        starts, ends = [a for a, _ in own], list(accumulate((b for _, b in own), max))
        for m in pattern.finditer(text):
            before = bisect_left(starts, m.end())
            if not before or ends[before - 1] <= m.start():
                found.append((kind, m.start(), m.end()))
    return found


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(text: str) -> tuple:
    base = base_spans(text)
    weak = weak_spans(text, base)
    kinds = [k for k, _, _ in base]
    parts = []
    if weak:
        breaks = [m.start() for m in BREAK.finditer(text)]
        for kind, a, b in base + weak:
            scope = bisect_left(breaks, a)
            parts.append({"kind": kind, "role": ROLE[kind], "weak": kind not in ("assign", "access", "hex"), "start": a, "end": b, "scope": scope})
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"), hashlib.sha256(shown(base).encode()).hexdigest(),
            [{"start": a, "rank": KINDS.index(k), "end": b, "kind": k} for k, a, b in base], parts)


_SPAN = pa.struct([("start", pa.int64()), ("rank", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
_PART = pa.struct([("kind", pa.string()), ("role", pa.string()), ("weak", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("scope", pa.int64())])
_SCAN = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
                   ("base", pa.list_(_SPAN)), ("parts", pa.list_(_PART))])
_SCAN_DDL = ("struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,"
             "base:array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>,"
             "parts:array<struct<kind:string,role:string,weak:boolean,start:bigint,end:bigint,scope:bigint>>>")


def scan(text: Column) -> Column:
    """Base counts and spans, and the candidates of texts that have a weak one; null counts as empty."""
    @F.arrow_udf(_SCAN_DDL)
    def scanned(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from in_blocks(columns, lambda part: list(zip(*[_scan(t) for t in part.to_pylist()])), _SCAN)

    return scanned(text)


def linked_parts(parts: DataFrame) -> DataFrame:
    """Weak rows of (key, scope, role, weak, kind, start, end) whose scope has all the roles they need, at any distance."""
    roles = parts.groupBy("key", "scope").agg(*[F.max(F.col("role") == r).alias(f"has_{r}") for r in ("id", "secret")])
    met = F.lit(False)
    for role, needs in NEEDS.items():
        own = F.col("role") == role
        for other in needs:
            own = own & F.col(f"has_{other}")
        met = met | own
    return parts.filter("weak").join(roles, ["key", "scope"]).filter(met).drop("has_id", "has_secret")


def _row_key(id_col: str, text_col: str) -> Column:
    """The same for rows that repeat both id and text, whose spans are the same."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.xxhash64(text_col).cast("string"))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its base counts and digest, and all its spans as an array ``found`` by start, then kind as listed.

    A null or empty text has no spans; null ids and repeated rows stay, each with its own spans; other columns are not read. The
    texts are scanned once; the join sees only the candidates of texts that have a weak one.
    """
    ship(docs.sparkSession)
    scanned = docs.select(F.col(id_col).alias("doc_id"), _row_key(id_col, text_col).alias("key"), scan(F.col(text_col)).alias("s"))
    table = settle(scanned.select("doc_id", "key", "s.*"), "secret-parts")
    parts = table.filter(F.size("parts") > 0).select("key", F.explode("parts").alias("p")).select("key", "p.*")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("long") - 1
    linked = (linked_parts(parts).groupBy("key")
              .agg(F.collect_set(F.struct("start", rank.alias("rank"), "end", "kind")).alias("linked")))
    everything = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>"))))
    return table.join(linked, "key", "left").withColumn("found", everything)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, digest of the base spans and all spans as text, for every row; see :func:`spans`."""
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    linked = (F.size("found") - F.size("base")).cast("long")
    return spans(docs, id_col, text_col).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"), linked.alias("n_linked"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; all rows and columns stay.

    Only rows with spans are joined back to their spans; the others keep their text as it is.
    """
    names = docs.columns
    key, tag = fresh(names, "row_key"), fresh([*names, "row_key"], "cuts")
    cuts = (spans(docs, id_col, text_col).filter(F.size("found") > 0)
            .select(F.col("key").alias(key), F.transform("found", lambda s: F.struct(s["start"], s["end"])).alias(tag)).dropDuplicates([key]))

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans_: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans_):
            text, kept, at = text.as_py(), [], 0
            for span in sorted(found.as_py() or (), key=lambda x: x["start"]):
                if span["start"] >= at:
                    kept += [text[at:span["start"]], mark]
                at = max(at, span["end"])
            out.append(text if at == 0 else "".join([*kept, text[at:]]))
        return pa.array(out, pa.string())

    joined = docs.withColumn(key, _row_key(id_col, text_col)).join(cuts, key, "left")
    return joined.withColumn(text_col, F.when(F.col(tag).isNotNull(), cut(F.col(text_col), F.col(tag))).otherwise(F.col(text_col))) \
        .select(*[F.col(f"`{c}`") for c in names])
