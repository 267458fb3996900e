"""Find secrets and link the parts of multipart credentials.

Sure kinds are reported wherever they match: ``assign`` (a value assigned to a name such
as ``token``), ``access`` (access identifiers) and ``hex`` (long hexadecimal runs). Weak
kinds are reported only where complementary parts co-occur:

* ``user`` (an assigned account name): with a secret;
* ``opaque`` (a long run that mixes cases and digits): with an identifier;
* ``endpoint`` (a url): with an identifier and a secret.

Identifiers are ``access`` and ``user``; secrets are ``assign``, ``hex`` and ``opaque``. A
weak candidate that overlaps a sure span is part of that span and not reported twice.

Scopes are nested intervals: the line, the paragraph (lines without an empty one between) and
the document. A candidate is joined to its complement in the smallest scope that holds both,
there to the nearest one; the document is the outermost, so a part is linked however far its
complement lies. ``links`` tells for each reported candidate what it was linked to and in
which scope, so far links can be judged apart.

Parts are found by patterns in Arrow batches and linked in Spark. Of all parts on one side of a
candidate the nearest one also lies in the smallest scope that any of them shares with it. So the interval join
needs no pairs of parts: one pass over the sorted parts of a document in each direction carries
the last identifier and the last secret along.

Positions are code points, end exclusive. Missing text is empty and has no spans. Rows
are told apart by their place, so missing or repeated ids are harmless.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from panelweave.llm.rows import free_names, from_files, located, with_place
from panelweave.llm.url_filters import bloom_filter, marked_hits
from panelweave.schema import quoted
from panelweave.llm.workers import releasing
from panelweave.sources.scratch import materialize

MASK = "[secret]"
SURE = ("assign", "access", "hex")
KINDS = (*SURE, "user", "opaque", "endpoint")

# The sure kinds' patterns.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

LONG_HEX = re.compile(r"[0-9a-f]{24,}")  # the same runs, without stopping at short ones
USER = re.compile(
    r"""(?ai:\b(?:user(?:name)?|login|account|client_?id|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})"""
)
OPAQUE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
MIXED = [re.compile(p) for p in ("[a-z]", "[A-Z]", "[0-9]")]
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9][^\s\"'<>]*")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
LINE = re.compile(r"\n")

SCOPES = ("line", "paragraph", "document")
PART = "struct<kind:int, start:int, end:int, line:int, paragraph:int>"


def sure_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the sure kinds, leftmost and not overlapping per kind."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [
            (1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    found += [(2, *m.span()) for m in LONG_HEX.finditer(text)]
    return found


def weak_spans(text: str, sure: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates that no sure span overlaps."""
    found = [(3, *m.span()) for m in USER.finditer(text)]
    found += [
        (4, *m.span()) for m in OPAQUE.finditer(text) if all(p.search(m[0]) for p in MIXED)
    ]
    if "://" in text:
        found += [(5, *m.span()) for m in ENDPOINT.finditer(text)]
    if not sure:
        return found
    taken = sorted((s, e) for _, s, e in sure)
    starts, reach, most = [s for s, _ in taken], [], 0
    for _, e in taken:
        most = max(most, e)
        reach.append(most)

    def free(start: int, end: int) -> bool:
        before = bisect_right(starts, end - 1)
        return before == 0 or reach[before - 1] <= start

    return [x for x in found if free(x[1], x[2])]


def written(spans: list[tuple[int, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed."""
    ordered = sorted(spans, key=lambda x: (x[1], x[0], x[2]))
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in ordered)


_FOUND = (
    "doc_id long, file string, place long, n_assign long, n_access long, n_hex long, "
    f"base_sha256 string, base string, parts array<{PART}>"
)
_PARTS = pa.list_(
    pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "line", "paragraph")])
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {n: [] for n in ("n_assign", "n_access", "n_hex", "sha", "base", "parts")}
        for value in batch.column("text"):
            text = value.as_py() or ""
            sure = sure_spans(text)
            weak = weak_spans(text, sure)
            kinds = [k for k, _, _ in sure]
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(kinds.count(k))
            base = written(sure)
            out["base"].append(base)
            out["sha"].append(hashlib.sha256(base.encode()).hexdigest())
            breaks = [m.end() for m in PARAGRAPH.finditer(text)] if weak else []
            ends = [m.end() for m in LINE.finditer(text)] if weak else []
            # Alone, sure spans need no link.
            out["parts"].append(
                [
                    {"kind": k, "start": s, "end": e, "line": bisect_right(ends, s),
                     "paragraph": bisect_right(breaks, s)}
                    for k, s, e in (sure + weak if weak else [])
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("file"), batch.column("place"),
                pa.array(out["n_assign"], pa.int64()), pa.array(out["n_access"], pa.int64()),
                pa.array(out["n_hex"], pa.int64()), pa.array(out["sha"], pa.string()),
                pa.array(out["base"], pa.string()), pa.array(out["parts"], _PARTS),
            ],
            names=["doc_id", "file", "place", "n_assign", "n_access", "n_hex",
                   "base_sha256", "base", "parts"],
        )


def _said(part: Column | None = None) -> Column:
    """``kind:start:end`` of a part, or of the row itself."""
    kind, start, end = (F.col(c) if part is None else part[c] for c in ("kind", "start", "end"))
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), kind + 1)
    return F.concat_ws(":", name, start, end)


def linked(parts: DataFrame) -> DataFrame:
    """Weak parts with their complements: ``file, place, kind, start, end, said, links``.

    ``parts`` has ``file, place, kind, start, end, line, paragraph``.
    """
    order = ["start", "end", "kind"]
    onward = Window.partitionBy("file", "place").orderBy(*order)
    back = Window.partitionBy("file", "place").orderBy(*[F.desc(c) for c in order])
    itself = F.struct("kind", "start", "end", "line", "paragraph")
    beside = {}
    for role, kinds in (("id", (1, 3)), ("secret", (0, 2, 4))):
        part = F.when(F.col("kind").isin(*kinds), itself)
        for side, window in (("before", onward), ("after", back)):
            before = window.rowsBetween(Window.unboundedPreceding, -1)
            beside[f"{role}_{side}"] = F.last(part, ignorenulls=True).over(before)
    # No weak part is its own complement.
    found = parts.withColumns(beside).where("kind >= 3")

    def nearest(role: str) -> Column:
        """The complement in the smallest scope, there the nearest, and of two as near the first."""
        sides = []
        for turn, side in enumerate(("before", "after")):
            other = F.col(f"{role}_{side}")
            scope = F.when(other["line"] == F.col("line"), 0).when(other["paragraph"] == F.col("paragraph"), 1).otherwise(2)
            gap = F.greatest(F.col("start") - other["end"], other["start"] - F.col("end"), F.lit(0))
            sides.append(F.when(other.isNotNull(), F.struct(
                scope.alias("scope"), gap.alias("gap"), F.lit(turn).alias("turn"), _said(other).alias("said"),
            )))
        return F.array_min(F.filter(F.array(*sides), lambda s: s.isNotNull()))

    found = found.withColumns({"id": nearest("id"), "secret": nearest("secret")}).where(
        "(kind = 3 AND secret IS NOT NULL) OR (kind = 4 AND id IS NOT NULL) "
        "OR (kind = 5 AND id IS NOT NULL AND secret IS NOT NULL)"
    )
    scopes = F.array(*[F.lit(s) for s in SCOPES])

    def link(role: str) -> Column:
        return F.concat(_said(), F.lit(">"), F.col(role)["said"], F.lit("@"), F.element_at(scopes, F.col(role)["scope"] + 1))

    wanted = F.when(F.col("kind") == 3, F.array(link("secret"))).when(F.col("kind") == 4, F.array(link("id")))
    links = F.array_join(wanted.otherwise(F.array(link("id"), link("secret"))), ",")
    return found.select("file", "place", "kind", "start", "end", _said().alias("said"), links.alias("links"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, ``spans`` and ``links``, besides ``file`` and ``place``."""
    rows = located(docs, "doc_id", "text")
    found = materialize(rows.mapInArrow(releasing(_find), _FOUND), "secrets")
    parts = found.where("size(parts) > 0").select("file", "place", F.inline("parts"))
    more = linked(parts).groupBy("file", "place").agg(
        F.collect_list(F.struct("start", "kind", "end", "said")).alias("more"),
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "links"))).alias("links"),
    )
    own = F.expr(
        "transform(filter(split(base, ','), x -> x <> ''), x -> named_struct("
        "'start', cast(split(x, ':')[1] AS int), "
        f"'kind', cast(array_position(array{SURE}, split(x, ':')[0]) - 1 AS int), "
        "'end', cast(split(x, ':')[2] AS int), 'said', x))"
    )
    every = F.array_sort(F.concat(own, F.coalesce("more", F.array().cast(
        "array<struct<start:int, kind:int, end:int, said:string>>"))))
    return found.join(more, ["file", "place"], "left").select(
        "doc_id", "file", "place", "n_assign", "n_access", "n_hex", "base_sha256",
        F.when(F.col("more").isNull(), F.col("base"))
        .otherwise(F.array_join(every["said"], ",")).alias("spans"),
        F.coalesce(F.array_join(F.col("links")["links"], ","), F.lit("")).alias("links"),
    )


def _mask(spans: str, text: str) -> str:
    cuts = sorted((int(s), int(e)) for _, s, e in (x.split(":") for x in spans.split(",")))
    out, at = [], 0
    for start, end in cuts:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns, with every reported span of ``text`` replaced by ``MASK``.

    ``n_chars``, where there is one, is counted anew for changed texts.
    """
    docs = from_files(docs)
    file, place, spans, likely = free_names(docs, "row_file", "row_place", "spans", "likely")
    found = scan(docs).where("spans <> ''").select(
        F.col("file").alias(file), F.col("place").alias(place), F.col("spans").alias(spans)
    )
    # Written, as the filter and the join read it. Only texts that the filter lets through are shuffled.
    found = materialize(found, "found-secrets")
    at = F.concat_ws("#", file, place)
    bloom = bloom_filter(found.select(at.alias("key")))

    @F.pandas_udf("string")
    def masked(spans, text):
        return text.__class__(
            [t if s is None else _mask(s, t) for s, t in zip(spans, text, strict=True)]
        )

    columns = [F.col(quoted(c)) for c in docs.columns]
    marked = marked_hits(with_place(docs, file, place), bloom, at, likely)
    clean = marked.where(~F.col(likely)).select(*columns)
    joined = marked.where(F.col(likely)).join(found, [file, place], "left")
    changed = joined.withColumn("text", masked(spans, "text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col(spans).isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", counted)
    return clean.unionByName(changed.select(*columns))
