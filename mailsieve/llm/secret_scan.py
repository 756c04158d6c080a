"""Secret scan that links the parts of a credential: identifier, secret, endpoint.

Strong kinds are reported wherever they stand:

* ``assign``: a key word, a separator and a value of 12 characters or more,
* ``access``: ``AKIA`` and upper-case letters or digits, 18 characters or more,
* ``hex``: 16 or more lower-case hexadecimal digits.

Weak kinds (``account``, ``mail``, ``endpoint``, ``opaque``) say little alone. They are
reported only when a part of a complementary role lies in the same scope, that is within
``scope`` code points: a secret needs an identifier or an endpoint, an identifier or an
endpoint needs a secret. The partners are found by an interval join on (row, role, cell):
positions are cut into cells of the scope's width, a part is posted under every cell it
covers, and all parts of a role in a cell are reduced to the first and last position they
cover there before the join, so a text with many parts yields a few rows per cell and
never all pairs. A cell is narrower than what a part reaches, so the two positions tell.

Defined results: null and empty texts have no spans; positions are code points, the end
exclusive; equal rows are scanned one by one; an empty table gives an empty result;
null ids pass through; extra columns of any name are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.llm.common import free_names, map_arrow, written

# The strong patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 18
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "account", "mail", "endpoint", "opaque")
STRONG = KINDS[:3]

# Weak patterns of this library.
ACCOUNT = re.compile(
    r"""(?:user_?name|user|login|account|client_?id|tenant)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
MAIL = re.compile(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ENDPOINT = re.compile(r"[a-z][a-z0-9+]{1,15}://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+")
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
ROLES = {
    "assign": "secret",
    "hex": "secret",
    "opaque": "secret",
    "access": "identifier",
    "account": "identifier",
    "mail": "identifier",
    "endpoint": "endpoint",
}
NEEDS = {"secret": ("identifier", "endpoint"), "identifier": ("secret",), "endpoint": ("secret",)}
SCOPE = 400

_PART = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PARTS = "array<struct<kind:string,start:bigint,end:bigint>>"


def _mixed(value: str) -> bool:
    """Letters of both cases and digits, as in a random string and hardly in a word."""
    return (
        any(c.isdigit() for c in value)
        and any(c.islower() for c in value)
        and any(c.isupper() for c in value)
    )


def find_parts(text: str) -> tuple[list, list]:
    """(strong, weak) parts of one text as (kind, start, end)."""
    strong = []
    small = text.lower()
    # A key word can only match where its stem stands; looking for stems is cheap.
    if "passw" in small or "secret" in small or "token" in small or "api" in small:
        strong += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        strong += [
            ("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH
        ]
    strong += [("hex", *m.span()) for m in HEX.finditer(text)]
    weak = []
    if ":" in text or "=" in text:
        if any(stem in small for stem in ("user", "login", "account", "client", "tenant")):
            weak += [("account", *m.span()) for m in ACCOUNT.finditer(text)]
        if "://" in text:
            weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if "@" in text:
        weak += [("mail", *m.span()) for m in MAIL.finditer(text)]
    # An opaque string needs an identifier or an endpoint beside it.
    if weak or any(kind == "access" for kind, _, _ in strong):
        weak += [("opaque", *m.span()) for m in OPAQUE.finditer(text) if _mixed(m.group())]
    strong.sort(key=lambda part: (part[1], KINDS.index(part[0])))
    return strong, _clear(sorted(weak, key=lambda part: (part[1], KINDS.index(part[0]))), strong)


def _clear(weak: list, strong: list) -> list:
    """The weak parts that overlap no strong one. Both are sorted by start."""
    kept, i, reach = [], 0, 0
    for part in weak:
        while i < len(strong) and strong[i][1] < part[2]:
            reach = max(reach, strong[i][2])
            i += 1
        if reach <= part[1]:
            kept.append(part)
    return kept


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [find_parts(text or "") for text in batch.column(2).to_pylist()]
        columns = [
            pa.array([[dict(zip(("kind", "start", "end"), p, strict=True)) for p in row[side]] for row in found], pa.list_(_PART))
            for side in (0, 1)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *columns], ["row_no", "doc_id", "strong", "weak"]
        )


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """One row per row of ``docs``: row_no, doc_id, spans (kind, start, end by start)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    found = written(
        map_arrow(
            docs.select(
                F.monotonically_increasing_id().alias("row_no"),
                docs[id_col].alias("doc_id"),
                docs[text_col].cast("string").alias("text"),
            ),
            _scan,
            f"row_no bigint, doc_id {id_type}, strong {_PARTS}, weak {_PARTS}",
        ),
        "secret-parts",
    )
    role = F.element_at(F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv]), F.col("part.kind"))
    needs = F.element_at(
        F.create_map(*[x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]), role
    )
    candidates = found.where(F.size("weak") > 0)
    parts = candidates.select("row_no", F.explode(F.concat("strong", "weak")).alias("part"))
    cells = F.sequence(F.expr(f"part.start div {scope}"), F.expr(f"part.end div {scope}"))
    points = (
        parts.select("row_no", role.alias("role"), "part", F.explode(cells).alias("cell"))
        .groupBy("row_no", "role", "cell")
        .agg(
            F.min(F.greatest(F.col("part.start"), F.col("cell") * scope)).alias("first"),
            F.max(F.least(F.col("part.end"), F.col("cell") * scope + (scope - 1))).alias("last"),
        )
    )
    reach = (
        candidates.select("row_no", F.explode("weak").alias("part"))
        .select("row_no", "part", F.explode(needs).alias("role"))
        .select(
            "*",
            F.explode(
                F.sequence(
                    F.expr(f"greatest(0, part.start - {scope}) div {scope}"),
                    F.expr(f"(part.end + {scope}) div {scope}"),
                )
            ).alias("cell"),
        )
    )
    linked = (
        reach.join(points, ["row_no", "role", "cell"])
        .where(
            (F.col("last") >= F.col("part.start") - scope)
            & (F.col("first") <= F.col("part.end") + scope)
        )
        .groupBy("row_no")
        .agg(F.collect_set("part").alias("linked"))
    )
    none = F.array().cast(_PARTS)
    spans = F.array_sort(
        F.transform(
            F.concat("strong", F.coalesce("linked", none)),
            lambda p: F.struct(p["start"].alias("start"), _rank(p["kind"]).alias("rank"), p["end"].alias("end"), p["kind"].alias("kind")),
        )
    )
    return found.join(linked, "row_no", "left").select(
        "row_no",
        "doc_id",
        F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
    )


def span_list(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _mask(text: str | None, spans: list | None) -> str | None:
    """Overlapping spans are masked as one, under the name of the first."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for span in spans:
        if span["start"] >= at:
            out += [text[at : span["start"]], f"[{span['kind']}]"]
        at = max(at, span["end"])
    return "".join([*out, text[at:]])


def _mask_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the table, its text, its spans; the spans are left out of the result."""
    for batch in batches:
        at = batch.num_columns - 2
        texts, spans = batch.column(at), batch.column(at + 1)
        found = pc.is_valid(spans)
        if pc.any(found).as_py():
            pairs = zip(texts.filter(found).to_pylist(), spans.filter(found).to_pylist(), strict=True)
            texts = pc.replace_with_mask(texts, found, pa.array([_mask(*pair) for pair in pairs], texts.type))
        columns = [*batch.columns[:at], texts]
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[: at + 1])


def mask_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all rows stay.

    Rows are told apart by id and text, so equal rows get equal spans. Texts without
    spans, null and empty ones are left as they are.
    """
    span_id, span_key, found, doc_key, text = free_names(
        docs.columns, "_span_id", "_span_key", "_spans", "_doc_key", "_masked_text"
    )
    key = F.sha2(F.coalesce(docs[text_col], F.lit("")), 256)
    keyed = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    keyed = keyed.select(F.struct("_id", F.sha2(F.coalesce("_text", F.lit("")), 256).alias("_key")).alias("_id"), "_text")
    spans = (
        scan_secrets(keyed, "_id", "_text", scope)
        .where(F.size("spans") > 0)
        .groupBy("doc_id")
        .agg(F.first("spans").alias(found))
        .select(F.col("doc_id._id").alias(span_id), F.col("doc_id._key").alias(span_key), found)
    )
    joined = docs.withColumn(doc_key, key).join(
        spans, F.col(id_col).eqNullSafe(F.col(span_id)) & (F.col(doc_key) == F.col(span_key)), "left"
    )
    others = [f for f in docs.schema.fields if f.name != text_col]
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in others)
    marked = joined.select(*[f.name for f in others], F.col(text_col).alias(text), found)
    masked = map_arrow(marked, _mask_batches, f"{kinds}`{text}` string")
    return masked.withColumnRenamed(text, text_col).select(*docs.columns)
