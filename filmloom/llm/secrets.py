"""Secret scans with linked credential parts, in DataFrame functions only.

Strong candidates stand by themselves. Weak ones (short secrets, identifiers, endpoints) count only beside parts that
complete them: an interval join within a scope of ``SCOPE`` code points. Positions fall into bins as wide as the scope, and
a bin is summed up to its first and last position of each role before the join, so a candidate meets three rows a role
however many parts a text holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmloom.llm.common import text_key

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
IDENT = r"""(?i:(access_?key_?id|client_?id|account_?id|user_?name|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.=-]+)"""
ENDPOINT = r"""(?i:(https?|wss?|s3|postgres|mysql|mongodb|redis|amqp|ftp)://)([A-Za-z0-9_.:@/-]+)"""

#: Kinds in the order that decides ties; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "ident", "short", "endpoint")
SECRET, IDENTIFIER, PLACE = "secret", "identifier", "endpoint"
ROLE = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET, "ident": IDENTIFIER, "short": SECRET, "endpoint": PLACE}
#: Roles that must stand within the scope of a weak candidate.
NEEDS = {"ident": (SECRET,), "short": (IDENTIFIER,), "endpoint": (SECRET, IDENTIFIER)}
SCOPE = 400
CHUNK = 64
SPAN = "array<struct<start:long,kind:int,end:long>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Computes a value once for an expression that names it often."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _located(text: Column, pattern: str, group: int) -> Column:
    """Start, end and length of a group for every match, from the pieces between matches; prefix sums go chunk by chunk."""
    parts = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("own"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.length).alias("group"),
    )
    zero = F.lit(0).cast("long")
    none = F.expr("cast(array() as array<struct<start:long,end:long,group:int>>)")

    def width(x: Column) -> Column:
        return (x["gap"] + F.coalesce(x["own"], F.lit(0))).cast("long")

    def offsets(chunks: Column) -> Column:
        sums = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda s, x: s + width(x)))
        return F.aggregate(sums, F.array(zero), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)))

    def inside(chunk: Column, offset: Column) -> Column:
        def step(state: Column, x: Column) -> Column:
            start = state["at"] + x["gap"]
            span = F.struct(start.alias("start"), (start + x["own"]).alias("end"), x["group"].alias("group"))
            out = F.when(x["own"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span)))
            return F.struct((state["at"] + width(x)).alias("at"), out.alias("out"))

        return F.aggregate(chunk, F.struct(offset.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def spans(all_parts: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_parts) - 1) / CHUNK).cast("int")),
            lambda i: F.slice(all_parts, i * CHUNK + 1, F.lit(CHUNK)),
        )
        return _let(chunks, lambda c: F.flatten(F.zip_with(c, F.slice(offsets(c), F.lit(1), F.size(c)), inside)))

    return F.when(text.rlike(pattern), _let(parts, spans)).otherwise(none)


def _kind(found: Column, kind: str, keep: Callable[[Column], Column]) -> Column:
    return F.transform(
        F.filter(found, keep),
        lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")),
    )


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["end"])), ","
    )


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_key`` (the text's identity), ``_base`` and ``_weak`` spans; a null text counts as empty."""
    whole = F.coalesce(F.col(text), F.lit(""))
    assigned, access = F.col("_assigned"), F.col("_access")
    return (
        docs.withColumns(
            {
                "_key": text_key(F.col(text)),
                "_assigned": _located(whole, ASSIGN, 2),
                "_access": _located(whole, ACCESS, 0),
                "_hex": _located(whole, HEX, 0),
                "_ident": _located(whole, IDENT, 2),
                "_endpoint": _located(whole, ENDPOINT, 2),
            }
        )
        .withColumns(
            {
                "_base": F.concat(
                    _kind(assigned, "assign", lambda x: x["group"] >= 12),
                    _kind(access, "access", lambda x: x["end"] - x["start"] >= 18),
                    _kind(F.col("_hex"), "hex", lambda x: F.lit(True)),
                ).cast(SPAN),
                "_weak": F.concat(
                    _kind(F.col("_ident"), "ident", lambda x: x["group"] >= 3),
                    _kind(assigned, "short", lambda x: x["group"].between(6, 11)),
                    _kind(F.col("_endpoint"), "endpoint", lambda x: x["group"] >= 4),
                ).cast(SPAN),
            }
        )
        .drop("_assigned", "_access", "_hex", "_ident", "_endpoint")
    )


def linked(found: DataFrame) -> DataFrame:
    """``_key`` and ``_added``: the weak spans that their complements confirm. One row per different text that has any.

    Copies of a text are merged before anything is exploded, so no group of copies weighs more than one text.
    """
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("span.kind") + 1)
    spans = (
        found.where(F.size("_weak") > 0)
        .groupBy("_key")
        .agg(F.first("_base").alias("_base"), F.first("_weak").alias("_weak"))
        .select("_key", F.size("_base").alias("_n_base"), F.posexplode(F.concat("_base", "_weak")).alias("_pos", "span"))
        .select("_key", role.alias("role"), F.col("_pos") >= F.col("_n_base"), "span")
        .toDF("_key", "role", "weak", "span")
        .withColumn("bin", F.floor(F.col("span.start") / SCOPE))
    )
    bins = spans.groupBy("_key", "role", "bin").agg(F.min("span.start").alias("low"), F.max("span.start").alias("high"))
    near = bins.select("_key", "role", "low", "high", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)])).alias("bin"))
    needs = F.array(
        *[F.array(*[F.lit(r) for r in NEEDS.get(k, ())]).cast("array<string>") for k in KINDS]
    )
    weak = spans.where("weak").select("_key", "bin", "span", F.explode(F.element_at(needs, F.col("span.kind") + 1)).alias("role"))
    start = F.col("span.start")
    within = (F.col("low") <= start + SCOPE) & (F.col("high") >= start - SCOPE)
    complete = F.element_at(F.array(*[F.lit(len(NEEDS.get(k, ()))) for k in KINDS]), F.col("span.kind") + 1)
    return (
        weak.join(near, ["_key", "bin", "role"])
        .where(within)
        .groupBy("_key", "span")
        .agg(F.count_distinct("role").alias("met"))
        .where(F.col("met") == complete)
        .groupBy("_key")
        .agg(F.collect_list("span").alias("_added"))
    )


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts, ``base_sha256``, ``spans`` (all kinds) and ``_spans`` (the same as an array in order).

    The result depends on a row's text alone: null and empty texts have no spans, repeated rows get equal results, an empty
    table gives an empty table. Columns of these names are replaced.
    """
    found = candidates(docs, text)
    every = F.array_sort(F.concat("_base", F.coalesce("_added", F.expr(f"cast(array() as {SPAN})"))))

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("_base", lambda x: x["kind"] == KINDS.index(kind))).cast("long")

    return (
        found.join(linked(found.select("_key", "_base", "_weak")), "_key", "left")
        .withColumns({f"n_{k}": of_kind(k) for k in KINDS[:3]})
        .withColumns({"base_sha256": F.sha2(_listed(F.col("_base")), 256), "spans": _listed(every), "_spans": every})
        .drop("_key", "_base", "_weak", "_added")
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The documents with every found span replaced by a mark; overlapping spans share one. Other texts stay as they are."""

    def step(state: Column, x: Column) -> Column:
        ahead = x["start"] >= state["at"]
        piece = F.substring(F.col(text), (state["at"] + 1).cast("int"), (x["start"] - state["at"]).cast("int"))
        out = F.when(ahead, F.concat(state["out"], F.array(piece, F.lit(mark)))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    rest = F.lit(2**31 - 1)
    joined = F.aggregate(
        "_spans",
        start,
        step,
        lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col(text), (s["at"] + 1).cast("int"), rest)),
    )
    replaced = {text: F.when(F.size("_spans") > 0, joined).otherwise(F.col(text))}
    outputs = {*(f"n_{k}" for k in KINDS[:3]), "base_sha256", "spans"} & {*docs.columns}
    out = scan(docs.withColumnsRenamed({c: f"_own_{c}" for c in outputs}), text).withColumns(replaced)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"_own_{c}").alias(c) if c in outputs else F.col(c) for c in docs.columns])
