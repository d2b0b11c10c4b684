"""Information-theoretic sanitisation: personal data, and the terms that reveal it.

Personal data (email, ip, card, phone) are the protected entities.  Lines are the contexts.  Over the whole
corpus, a term's disclosure of a kind is its pointwise mutual information with the kind, as a share of
the kind's information content: 1 when the term never occurs without it.

    pmi(t, c) = log2(n(t, c) * N / (n(t) * n(c)))        ic(c) = log2(N / n(c))

Beside an entity, a term whose disclosure reaches `GENERALISE` is replaced by the name of the kind it
reveals, and one that reaches `REMOVE` is removed.  Only terms seen with a kind in at least `SUPPORT` lines count.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamloader.llm.common import column, columns, cut, discard, scratch_path, small_batches

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 5
GENERALISE = 0.7
REMOVE = 0.9
# What stands for a removed term: nothing at all would let the text around it join up.
REMOVED = "[REMOVED]"
# A task hands over its term counts when it holds this many terms.
HELD_TERMS = 400_000
# Rows of a side that may be broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits can only match from its first digit on, so the look-behind changes no match.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        else:
            end = at + 1
        at = text.find("@", end)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def _luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def entities(text: str) -> list[Span]:
    """Base spans in code points: by start, then by kind in the order of `KINDS`."""
    found = list(_emails(text))
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.groups()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
        found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def _kinds_by_line(text: str, spans: list[Span]) -> dict[int, int]:
    """Start of each line that an entity begins in, with a bit for each kind in it."""
    kinds: dict[int, int] = defaultdict(int)
    for kind, start, _ in spans:
        kinds[text.rfind("\n", 0, start) + 1] |= 1 << KINDS.index(kind)
    return kinds


def candidate_terms(text: str, spans: list[Span]) -> list[tuple[str, int, int, int]]:
    """Words (term, start, end, kinds) of the lines with entities, outside the entities."""
    found = []
    taken = sorted((s, e) for _, s, e in spans)
    for line, kinds in sorted(_kinds_by_line(text, spans).items()):
        stop = text.find("\n", line)
        stop = len(text) if stop < 0 else stop
        k = 0
        for m in _WORD.finditer(text, line, stop):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if k == len(taken) or taken[k][0] >= m.end():
                found.append((m[0].lower(), m.start(), m.end(), kinds))
    return found


COUNTS = "term string, n long, n_email long, n_ip long, n_card long, n_phone long"
SCAN = (
    "row_id long, spans array<struct<kind:string,start:int,end:int>>, "
    "terms array<struct<term:string,start:int,end:int,kinds:int>>"
)


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Lines holding a term, and lines holding it beside each kind; the null term counts the lines."""
    small_batches(docs.sparkSession)

    def flush(counts: dict) -> pa.RecordBatch:
        terms, rows = list(counts), list(counts.values())
        arrays = [pa.array(terms, pa.string())] + [pa.array([r[k] for r in rows], pa.int64()) for k in range(5)]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in COUNTS.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str | None, list[int]] = {}
        for batch in batches:
            for text in column(batch, "body"):
                text = text or ""
                marked = _kinds_by_line(text, entities(text))
                at = 0
                for line in text.split("\n"):
                    kinds = marked.get(at, 0)
                    at += len(line) + 1
                    terms: set[str | None] = set(_WORD.findall(line.lower()))
                    terms.add(None)
                    for term in terms:
                        row = counts.get(term)
                        if row is None:
                            row = counts[term] = [0, 0, 0, 0, 0]
                        row[0] += 1
                        if kinds:
                            for k in range(4):
                                row[k + 1] += kinds >> k & 1
            if len(counts) > HELD_TERMS:
                yield flush(counts)
                counts = {}
        if counts:
            yield flush(counts)

    partial = docs.select(F.col(text_col).alias("body")).mapInArrow(run, COUNTS)
    sums = [F.sum(c).alias(c) for c in ("n", "n_email", "n_ip", "n_card", "n_phone")]
    return partial.groupBy("term").agg(*sums)


def disclosing_terms(
    counts: DataFrame, support: int = SUPPORT, generalise: float = GENERALISE
) -> DataFrame:
    """(term, kind int, disclosure double): terms that reveal a kind to at least `generalise`."""
    near = cut(
        counts.where(F.col("term").isNull() | (F.greatest("n_email", "n_ip", "n_card", "n_phone") >= support))
    )
    whole = near.where("term is null").select("n", "n_email", "n_ip", "n_card", "n_phone").first()
    per_kind = []
    for k, kind in enumerate(KINDS):
        if not whole or not whole[f"n_{kind}"] or whole[f"n_{kind}"] >= whole["n"]:
            continue
        pmi = F.log2(F.col(f"n_{kind}") * float(whole["n"]) / (F.col("n") * float(whole[f"n_{kind}"])))
        share = pmi / F.log2(F.lit(whole["n"] / whole[f"n_{kind}"]))
        per_kind.append(F.struct(F.lit(k).alias("kind"), F.col(f"n_{kind}").alias("seen"), share.alias("disclosure")))
    if not per_kind:
        return near.limit(0).selectExpr("term", "0 as kind", "0d as disclosure")
    rows = near.where("term is not null").select("term", F.explode(F.array(*per_kind)).alias("r"))
    return rows.where((F.col("r.seen") >= support) & (F.col("r.disclosure") >= generalise)).select(
        "term", "r.kind", "r.disclosure"
    )


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with row_id, base spans and candidate terms, packed as (record, row_id, spans, terms)."""
    small_batches(docs.sparkSession)
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.col(f"`{text_col}`").alias("body")
    )
    schema = T.StructType([packed.schema["record"], *T.StructType.fromDDL(SCAN).fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 40
        for batch in batches:
            spans, terms = [], []
            for text in column(batch, "body"):
                found = entities(text or "")
                spans.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in found])
                near = candidate_terms(text, found) if found else []
                terms.append([dict(zip(("term", "start", "end", "kinds"), t, strict=True)) for t in near])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("record"),
                    pa.array(range(row, row + len(spans)), pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array(
                        terms,
                        pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("kinds", pa.int32())])),
                    ),
                ],
                ["record", "row_id", "spans", "terms"],
            )
            row += len(spans)

    return packed.mapInArrow(run, schema)


def revealing_spans(scanned: DataFrame, risky: DataFrame, remove: float = REMOVE) -> DataFrame:
    """(row_id, added): the spans of disclosing terms beside the kind they disclose, by start."""
    words = scanned.select("row_id", F.explode("terms").alias("t")).select("row_id", "t.*")
    hits = words.join(risky, "term").where(F.expr("shiftright(kinds, kind) % 2 = 1"))
    best = hits.groupBy("row_id", "start", "end").agg(F.max(F.struct("disclosure", "kind")).alias("r"))
    return best.groupBy("row_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct("start", "end", F.col("r.kind").alias("kind"), (F.col("r.disclosure") >= remove).alias("remove"))
            )
        ).alias("added")
    )


def sanitise(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] | None = None, learn_from: DataFrame | None = None,
    path: str | None = None,
) -> DataFrame:
    """(record, spans, added) per row: base spans, and the spans of terms that reveal them.

    `record` holds the columns in `keep` (default all); `learn_from` is the corpus of the counts (default
    `docs`).  Null and empty texts have no spans; repeated rows are separate rows; an empty table gives no
    rows.  The scan is written to `path` (default: the shared folder) and read back.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "scanned")
    risky = cut(disclosing_terms(term_counts(docs if learn_from is None else learn_from, text_col)))
    scanned = scan(docs, text_col)
    if keep is not None:
        scanned = scanned.withColumn("record", F.struct(*[F.col(f"record.`{c}`") for c in keep]))
    schema = scanned.schema
    scanned.write.parquet(path)
    scanned = spark.read.schema(schema).parquet(path)
    added = cut(revealing_spans(scanned, risky))
    if added.count() <= BROADCAST_ROWS:
        added = F.broadcast(added)
    return scanned.join(added, "row_id", "left").select("record", "spans", "added")


def redact(text: str, spans: Iterable[tuple[int, int, str]]) -> str:
    """Replace spans (start, end, replacement), left to right; a span inside an earlier one is dropped."""
    out, at = [], 0
    for start, end, word in sorted(spans):
        if start >= at:
            out += [text[at:start], word]
        at = max(at, end)
    return "".join([*out, text[at:]])


def replacements(spans: list[dict] | None, added: list[dict] | None) -> list[tuple[int, int, str]]:
    """Entities become their kind; terms become the kind they reveal, or are removed."""
    base = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in spans or []]
    terms = [
        (s["start"], s["end"], REMOVED if s["remove"] else f"[{KINDS[s['kind']].upper()}-RELATED]") for s in added or []
    ]
    return base + terms


def redactor() -> Callable:
    """A function for mapInArrow: (record, spans, added) to the record's columns with `text` redacted."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans, added = columns(batch, "text", "spans", "added")
            done = [
                t if t is None or not (s or a) else redact(t, replacements(s, a))
                for t, s, a in zip(texts, spans, added, strict=True)
            ]
            names = [n for n in batch.schema.names if n not in ("spans", "added")]
            arrays = [pa.array(done, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def sanitised_text(found: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """The columns `fields` of `record`, with personal data and revealing terms replaced in `text`."""
    flat = found.select(*[F.col(f"record.`{c}`").alias(c) for c in fields], "spans", "added")
    return flat.mapInArrow(redactor(), T.StructType([f for f in flat.schema if f.name in fields]))


def digest(found: DataFrame, path: str) -> DataFrame:
    """Counts, digest of the base spans and list of all spans; `path`, the scan's folder, is deleted."""
    n = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS]
    base = F.transform(
        "spans",
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("rank"),
            s["kind"].alias("kind"),
            s["end"].alias("end"),
        ),
    )
    terms = F.transform(
        F.coalesce("added", F.array()),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(len(KINDS) + 1).alias("rank"), F.lit(TERM).alias("kind"), s["end"].alias("end")
        ),
    )

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    out = cut(
        found.select(
            F.col("record.doc_id").alias("doc_id"),
            *n,
            F.sha2(joined(base), 256).alias("base_sha256"),
            joined(F.sort_array(F.concat(base, terms))).alias("spans"),
        )
    )
    discard(out.sparkSession, path)
    return out
