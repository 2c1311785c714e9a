"""Secrets in whole texts, told apart by who owns them across the corpus."""

from __future__ import annotations

import hashlib
import re
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanloom.llm import arrays
from loanloom.session import materialize

#: Kinds in order, their patterns and least lengths.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "bare")
LEAST_ASSIGNED = 8
KEYWORDS = ("passw", "secret", "token", "api")
#: A value without a name beside it: long, and of upper case, lower case and digits.
BARE = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
MIXED = (re.compile("[A-Z]"), re.compile("[a-z]"), re.compile("[0-9]"))


def find(text: str) -> list[tuple[int, str, int, str]]:
    """``(start, kind, end, value)`` by start, then kind as listed; code points, end exclusive.

    The three base kinds are leftmost, non-overlapping matches per kind. ``bare`` adds long
    mixed values that overlap none of them.
    """
    out = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_ASSIGNED:
                out.append((m.start(), "assign", m.end(), m[2]))
    if "AKIA" in text:
        out += [(m.start(), "access", m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), "hex", m.end(), m[0]) for m in HEX.finditer(text)]
    taken, at, reach = sorted((a, b) for a, _, b, _ in out), 0, 0
    for m in BARE.finditer(text):
        # both go by their begin: whatever begins before this one's end and reaches into it overlaps
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start() and all(p.search(m[0]) for p in MIXED):
            out.append((m.start(), "bare", m.end(), m[0]))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def _scan(batches):
    for batch in arrays.pieces(batches, "text"):
        rows = []
        for row, doc, owner, repository, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            found = find(text or "")
            named = [f"{k}:{a}:{b}" for a, k, b, _ in found]
            base = ",".join(n for n in named if not n.startswith("bare"))
            kinds = [k for _, k, _, _ in found]
            rows.append((
                row, doc, owner, repository, *(kinds.count(k) for k in KINDS[:3]),
                hashlib.sha256(base.encode()).hexdigest(), ",".join(named),
                [{"kind": k, "start": a, "end": b, "hash": hashlib.sha256(v.encode()).digest()[:16]}
                 for a, k, b, v in found],
            ))
        spans = pa.list_(pa.struct(
            [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.binary())]
        ))
        kinds = [*[batch.schema.field(i).type for i in range(4)], *[pa.int64()] * 3, pa.string(), pa.string(), spans]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
            ["row", "id", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"],
        )


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    repository_column: str | None = None,
    example_owners: int = 3,
    example_repositories: int = 5,
    row_column: str | None = None,
) -> DataFrame:
    """Candidate secrets of every document and how widely each is spread.

    Returns a row per document: ``row``, the id, ``n_assign``, ``n_access``, ``n_hex``,
    ``base_sha256``, ``spans`` (base kinds and ``bare``), ``found`` (array of kind, start,
    end, n_owners, n_repositories, live), ``n_live`` and ``n_example``.

    The hash of each candidate value is counted over the whole corpus by distinct owners
    and distinct repositories (the document itself without ``repository_column``). A value
    with ``example_owners`` owners or more, in ``example_repositories`` repositories or
    more, is a widely copied example; any other looks live. Values leave a task only as
    hashes. Pairs of hash and owner are made distinct before they are counted, so a value
    in a third of all documents is one row per owner.

    Null text is empty. A null owner or repository counts as none. Rows with equal or null
    ids stay apart by ``row``. An empty table gives no rows.
    """
    row = F.col(row_column) if row_column else F.monotonically_increasing_id()
    repository = F.col(repository_column).cast("string") if repository_column else F.col(id_column).cast("string")
    source = docs.select(
        row.alias("row"), F.col(id_column).alias("id"), F.col(owner_column).cast("string").alias("owner"),
        repository.alias("repository"), F.col(text_column).alias("text"),
    )
    kind = source.schema["id"].dataType.simpleString()
    scanned = materialize(
        source.mapInArrow(
            _scan,
            f"row long, id {kind}, owner string, repository string, n_assign long, n_access long, n_hex long, "
            "base_sha256 string, spans string, "
            "found array<struct<kind: string, start: bigint, end: bigint, hash: binary>>",
        ),
        "scanned",
    )
    candidates = scanned.select("row", "owner", "repository", F.explode("found").alias("c")).select(
        "row", "owner", "repository", "c.*"
    )
    owners = candidates.select("hash", "owner").distinct().groupBy("hash").agg(
        F.count("owner").alias("n_owners")
    )
    repositories = candidates.select("hash", "repository").distinct().groupBy("hash").agg(
        F.count("repository").alias("n_repositories")
    )
    wide = (F.col("n_owners") >= example_owners) & (F.col("n_repositories") >= example_repositories)
    judged = (
        candidates.select("row", "kind", "start", "end", "hash")
        .join(owners.join(repositories, "hash").withColumn("live", ~wide), "hash")
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(
            F.struct("start", "end", "kind", "n_owners", "n_repositories", "live")
        )).alias("found"))
    )
    live = F.size(F.filter("found", lambda s: s["live"]))
    clean = scanned.where(F.size("found") == 0).select(
        *[c for c in scanned.columns if c not in ("found", "owner", "repository")],
        F.lit(None).cast(judged.schema["found"].dataType).alias("found"),
    )
    dirty = scanned.where(F.size("found") > 0).drop("found", "owner", "repository").join(judged, "row")
    return clean.unionByName(dirty).select(
        "row", F.col("id").alias(id_column), "n_assign", "n_access", "n_hex", "base_sha256", "spans",
        F.coalesce("found", F.array().cast(judged.schema["found"].dataType)).alias("found"),
        F.coalesce(live, F.lit(0)).cast("long").alias("n_live"),
        F.coalesce(F.size("found") - live, F.lit(0)).cast("long").alias("n_example"),
    )


def _mark(batches, text):
    for batch in arrays.pieces(batches, text):
        column = batch.column(batch.schema.get_field_index(text))
        found = [bool(t) and bool(find(t)) for t in column.to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.bool_())], [*batch.schema.names, MARK])


#: Whether a text has any candidate, in the stored rows of :func:`redact`.
MARK = "__candidates"


def _redact(batches, at, mark):
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if spans:
                parts, last = [], 0
                for span in spans:
                    if span["end"] <= last:
                        continue
                    parts += [text[last : max(last, span["start"])], mark if span["start"] >= last else ""]
                    last = span["end"]
                text = "".join([*parts, text[last:]])
            out.append(text)
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(out, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def redact(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    owner_column: str = "source",
    length_column: str | None = "n_chars",
    mark: str = "[SECRET]",
    **limits,
) -> DataFrame:
    """``docs`` with every live-looking secret replaced by ``mark``; examples stay.

    No document goes. ``length_column``, where the table has it, is brought up to date on
    changed rows. The rows are stored once, with a number each and whether they hold any candidate;
    those without pass through, only the others are joined with what was found. See :func:`scan`.
    """
    names = docs.columns
    number, spans = "__row", "__live"
    while number in names:
        number += "_"
    while spans in names:
        spans += "_"
    if MARK in names:
        raise ValueError(f"a column named {MARK} is needed")
    numbered = docs.withColumn(number, F.monotonically_increasing_id())
    marked = StructType([*numbered.schema.fields]).add(MARK, "boolean")
    stored = materialize(numbered.mapInArrow(partial(_mark, text=text_column), marked), "numbered")
    able = stored.where(F.col(MARK)).drop(MARK)
    found = scan(able, id_column, text_column, owner_column, row_column=number, **limits)
    live = found.where("n_live > 0").select(
        F.col("row").alias(number),
        F.expr("transform(filter(found, s -> s.live), s -> struct(s.start as start, s.end as end))").alias(spans),
    )
    schema = docs.schema
    joined = able.join(live, number, "left").select(*names, spans)
    cleaned = joined.mapInArrow(partial(_redact, at=names.index(text_column), mark=mark), schema)
    if length_column in names:
        size = F.char_length(text_column).cast(schema[length_column].dataType)
        cleaned = cleaned.withColumn(length_column, F.coalesce(size, length_column))
    return stored.where(~F.col(MARK)).select(*names).unionByName(cleaned)
