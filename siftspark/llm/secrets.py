"""Secret scans, told apart by who owns the value across the corpus.

One pass finds candidate spans in whole texts: assignments, access keys and hex runs, and
values that only look like secrets. A candidate's value is hashed; per hash, distinct
repositories and owners are counted over the whole corpus (both partly before the shuffle,
so a value copied by everyone costs its owners, not its copies). A value spread over more
than `max_owners` owners is an example; one held by few is taken for a live credential.
Look-alikes count as findings only if live; the base kinds always do.

Defined results: NULL texts are empty; a NULL owner or repository is one of its own; rows repeated
whole are reported once each; a document without spans has empty lists; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftspark.llm.common import slices, staged
from siftspark.operators.scope import broadcast_if_small

# The kinds, in the order in which spans with one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "lookalike")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# A first look that each assignment passes, on text in lower case.
ASSIGN_WORDS = ("passw", "secret", "token", "api_key", "apikey")
LOOKALIKE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")
MIN_ENTROPY = 3.5

SPAN = "struct<kind:string,start:long,end:long,value_hash:string>"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in map(value.count, set(value)))


def find_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) in code points, by start and then kind."""
    spans = []
    small = text.lower()
    if any(w in small for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                spans.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((s[1], s[2]) for s in spans)
    for m in LOOKALIKE.finditer(text):
        value = m[0]
        if not re.search("[0-9]", value):
            continue
        if any(a < m.end() and m.start() < b for a, b in taken) or entropy(value) < MIN_ENTROPY:
            continue
        if re.search("[a-z]", value) and re.search("[A-Z]", value):
            spans.append(("lookalike", m.start(), m.end(), value))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(
    docs: DataFrame, owner: str = "source", repository: str = "source", digest: F.Column | None = None
) -> DataFrame:
    """row, doc_id, owner, repository, digest (if one is given), spans: every document with its candidate spans."""
    kept = {"row": "long", "doc_id": "long", "owner": "string", "repository": "string"}
    extra = [] if digest is None else [digest.alias("digest")]
    kept |= {"digest": "string"} if extra else {}
    schema = pa.schema(
        [
            *[(name, pa.int64() if kind == "long" else pa.string()) for name, kind in kept.items()],
            (
                "spans",
                pa.list_(
                    pa.struct(
                        [
                            ("kind", pa.string()),
                            ("start", pa.int64()),
                            ("end", pa.int64()),
                            ("value_hash", pa.string()),
                        ]
                    )
                ),
            ),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                [
                    {
                        "kind": kind,
                        "start": start,
                        "end": end,
                        "value_hash": hashlib.sha256(value.encode()).hexdigest(),
                    }
                    for kind, start, end, value in find_spans(text or "")
                ]
                for text in (cell.as_py() for cell in batch["text"])
            ]
            columns = [batch[c] for c in kept]
            spans = pa.array(found, schema.field("spans").type)
            yield pa.RecordBatch.from_arrays([*columns, spans], schema=schema)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        *extra,
        F.col("text").cast("string").alias("text"),
    )
    fields = "".join(f"{name} {kind}, " for name, kind in kept.items())
    return rows.mapInArrow(scan, f"{fields}spans array<{SPAN}>")


def ownership(found: DataFrame, max_owners: int = 3) -> DataFrame:
    """value_hash, owners, repositories, copies, live: one row per distinct candidate value."""
    each = found.select("owner", "repository", F.explode("spans").alias("_span"))
    held = each.groupBy(F.col("_span.value_hash").alias("value_hash"), "owner", "repository").agg(
        F.count(F.lit(1)).alias("copies")
    )
    # NULL is an owner too: count it beside the distinct names.
    def names(column: str):
        return F.count_distinct(column) + F.max(F.col(column).isNull().cast("int"))

    return held.groupBy("value_hash").agg(
        names("owner").alias("owners"),
        names("repository").alias("repositories"),
        F.sum("copies").alias("copies"),
        (names("owner") <= max_owners).alias("live"),
    )


def scan_secrets(
    docs: DataFrame,
    max_owners: int = 3,
    owner: str = "source",
    repository: str = "source",
    digest: F.Column | None = None,
) -> DataFrame:
    """row, doc_id, digest (if one is given), spans (with owners, repositories, live): one row per document.

    Base spans are kept whatever their owners; look-alikes only where they seem live.
    """
    found = staged(candidates(docs, owner, repository, digest), "candidates")
    values = staged(ownership(found, max_owners), "ownership")
    spans = found.select("row", F.explode("spans").alias("_s")).select("row", "_s.*")
    judged = (
        spans.join(broadcast_if_small(values), "value_hash")
        .filter(F.col("kind").isin(*BASE_KINDS) | F.col("live"))
        .withColumn("_kind_no", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")))
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("start", "_kind_no", "end", "kind", "owners", "repositories", "live")
                )
            ).alias("spans")
        )
    )
    none = F.array().cast(judged.schema["spans"].dataType)
    return (
        found.drop("owner", "repository", "spans")
        .join(judged, "row", "left")
        .withColumn("spans", F.coalesce("spans", none))
    )


def span_list(spans) -> F.Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def redact(docs: DataFrame, max_owners: int = 3) -> DataFrame:
    """The documents with every span replaced: live ones by <SECRET>, examples by <EXAMPLE>.

    Overlapping spans are replaced as one, live if any of them is. Equal texts have equal spans, and
    whether a value is live is the same for all texts, so spans find their rows by the text's digest.
    """
    digest = F.sha2(F.col("text"), 256)
    scanned = scan_secrets(docs, max_owners, digest=digest).filter(F.size("spans") > 0)
    marks = scanned.groupBy(F.col("digest").alias("_text")).agg(F.first("spans").alias("_spans"))
    marks = broadcast_if_small(staged(marks, "marks"))
    joined = docs.withColumn("_digest", digest).join(marks, F.col("_digest") == F.col("_text"), "left")
    with_text = joined.withColumn("text", _replace(F.col("text"), F.col("_spans")))
    if "n_chars" in docs.columns:
        size = F.when(F.col("_spans").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        with_text = with_text.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return with_text.select(*docs.columns)


def _replace(text, spans):
    """Fold over the spans, by start: the text written so far and where it continues."""
    start = F.struct(
        F.lit("").alias("done"), F.lit(0).cast("long").alias("at"), F.lit(False).alias("live")
    )

    def mark(state):
        shown = F.when(state["live"], "<SECRET>").otherwise("<EXAMPLE>")
        return F.when(state["at"] == 0, "").otherwise(shown)

    def step(state, s):
        # A span that begins before the last one's end only makes that one longer.
        apart = s["start"] >= state["at"]
        between = F.substr(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.when(
            apart | (state["at"] == 0),
            F.struct(
                F.concat(state["done"], mark(state), between).alias("done"),
                s["end"].alias("at"),
                s["live"].alias("live"),
            ),
        ).otherwise(
            F.struct(
                state["done"].alias("done"),
                F.greatest(state["at"], s["end"]).alias("at"),
                (state["live"] | s["live"]).alias("live"),
            )
        )

    def finish(state):
        return F.concat(
            state["done"], mark(state), F.substr(text, (state["at"] + 1).cast("int"))
        )

    return F.when(spans.isNull(), text).otherwise(F.aggregate(spans, start, step, finish))
