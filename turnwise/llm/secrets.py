"""Secret scans with corpus-wide ownership of the candidates (DataFrame functions only).

Spans of the base patterns stand by themselves. Beside them the scan takes long mixed tokens
as candidates. The hash of every candidate is counted over the corpus by distinct owners and
repositories: a value that several owners hold is a copied example, a value of one owner is
that owner's own and looks live. Live candidates become spans of the kind ``owned``; base
spans carry the same judgement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnwise.session import store

# Kinds in their order, pattern, the group whose length counts, least length.
KINDS = (
    (
        "assign",
        r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1, 8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
# A candidate beyond the base: a token of 24 characters or more with a capital, a small letter
# and a digit, as keys have it; words and plain numbers do not.
OWNED = (
    "owned",
    r"(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24,}",
    0, 24,
)
# Up to so many distinct owners and repositories a value is specific to its owner.
OWNERS, REPOSITORIES = 1, 4
SPAN = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"
MASK = "[secret]"


def _spans(text: Column, number: int, pattern: str, group: int, least: int) -> Column:
    """All matches of one kind as spans in code points, end exclusive.

    The texts between matches (a split) and the matches (an extraction) alternate, so their
    running lengths are the positions. Only texts with a match are split.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), 0)
    value = F.regexp_extract_all(text, F.lit(pattern), group)
    # A text that ends with a match has an empty last piece, which the zip leaves out.
    pieces = F.slice(F.split(text, pattern), 1, F.size(whole))
    zipped = F.arrays_zip(pieces.alias("p"), whole.alias("m"), value.alias("v"))
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("l"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(
            begin.cast("bigint").alias("start"), F.lit(number).alias("kind"),
            end.cast("bigint").alias("end"), x["v"].alias("value"),
        )
        more = F.when(F.length(x["v"]) >= least, F.array(span)).otherwise(none)
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["l"], more).alias("l"))

    return F.when(text.rlike(pattern), F.aggregate(zipped, start, step)["l"]).otherwise(none)


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``base`` and ``candidates``: spans (start, kind, end, value), base ones by start
    and kind. A null text counts as empty and has none."""
    whole = F.coalesce(F.col(text), F.lit(""))
    kinds = [
        # Runs shorter than the least length are dropped anyway; skipping them keeps texts
        # full of short runs cheap. The same spans come out.
        _spans(whole, i, p.replace("[0-9a-f]+", "(?<![0-9a-f])[0-9a-f]{32,}"), g, n)
        for i, (_, p, g, n) in enumerate(KINDS)
    ]
    owned = _spans(whole, len(KINDS), *OWNED[1:])
    out = docs.withColumn("base", F.array_sort(F.concat(*kinds))).withColumn("_owned", owned)
    # A candidate inside a base span is found already.
    apart = lambda c: ~F.exists(
        "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
    )
    return out.withColumn("candidates", F.filter("_owned", apart)).drop("_owned")


def ownership(found: DataFrame, owner: str, repository: list[str]) -> DataFrame:
    """One row per value hash: owners, repositories, uses, live.

    Every sum starts inside the tasks: first per (hash, owner, repository), then per (hash,
    owner), then per hash, so a value that a third of the corpus holds stays small.
    """
    each = found.select(
        F.col(owner).alias("owner"), F.xxhash64(*repository).alias("repository"),
        F.explode(F.concat("base", "candidates")).alias("s"),
    ).select("owner", "repository", F.sha2("s.value", 256).alias("hash"))
    by_repository = each.groupBy("hash", "owner", "repository").agg(F.count("*").alias("uses"))
    by_owner = by_repository.groupBy("hash", "owner").agg(
        F.count("*").alias("repositories"), F.sum("uses").alias("uses")
    )
    return by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"),
        F.sum("uses").alias("uses"),
    ).withColumn("live", (F.col("owners") <= OWNERS) & (F.col("repositories") <= REPOSITORIES))


def scan(
    docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"),
    id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document, without its text: id, row (a hash that tells rows of one id
    apart), base, spans (base and live candidates), live (base spans of an owner's own value)
    and copied (base spans of an example that several owners hold).

    Nulls in owner and repository are values like others. Equal rows get equal results.
    """
    found = store(
        find_spans(docs, text).select(
            F.col(id).alias("id"), F.xxhash64(text, owner, *repository).alias("row"),
            F.col(owner).alias("_owner"),
            *[F.col(c).alias(f"_repository_{i}") for i, c in enumerate(repository)],
            "base", "candidates",
        ),
        "spans",
    )
    parts = [c for c in found.columns if c.startswith("_repository")]
    judged = ownership(found, "_owner", parts).where("live").select("hash")
    # One row per (document, value); a value that everyone holds is not live and joins nothing.
    held = (
        found.where("size(base) + size(candidates) > 0")
        .select("id", "row", F.explode(F.concat("base", "candidates")).alias("s"))
        .select("id", "row", F.sha2("s.value", 256).alias("hash"))
        .distinct()
    )
    live = held.join(judged, "hash").groupBy("id", "row").agg(F.collect_set("hash").alias("own"))
    joined = found.join(
        live.withColumnRenamed("id", "_id").withColumnRenamed("row", "_row"),
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")),
        "left",
    )
    own = lambda s: F.array_contains(F.coalesce("own", F.array().cast("array<string>")), F.sha2(s["value"], 256))
    added = F.filter("candidates", own)
    lived = F.size(F.filter("base", own))
    return joined.select(
        F.col("id").alias(id), "row", "base", F.array_sort(F.concat("base", added)).alias("spans"),
        lived.cast("bigint").alias("live"), (F.size("base") - lived).cast("bigint").alias("copied"),
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k[0]) for k in (*KINDS, OWNED)])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    number = [k[0] for k in KINDS].index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")


def mask_spans(text: Column, spans: Column, mask: str = MASK) -> Column:
    """The text with every span replaced; spans that overlap give one mask."""
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = F.concat(state["out"], between, F.lit(mask))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"),
        )

    rest = lambda state: F.concat(
        state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text))
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def mask_documents(docs: DataFrame) -> DataFrame:
    """The documents with all their spans masked, and n_chars counted anew where the column
    is there. All documents stay."""
    # Written, so that the planner knows how small it is.
    found = store(
        scan(docs).where("size(spans) > 0").select(
            F.col("doc_id").alias("_tw_id"), F.col("row").alias("_tw_row"), F.col("spans").alias("_tw_spans")
        ).dropDuplicates(["_tw_id", "_tw_row"]),
        "masked",
    )
    joined = docs.withColumn("_tw_hash", F.xxhash64("text", "source", "source", "lang")).join(
        found, F.col("doc_id").eqNullSafe(F.col("_tw_id")) & (F.col("_tw_hash") == F.col("_tw_row")), "left"
    )
    held = F.col("_tw_spans").isNotNull()
    masked = F.when(held, mask_spans(F.col("text"), F.col("_tw_spans"))).otherwise(F.col("text"))
    changed = joined.withColumn("_tw_text", masked)
    columns = {"text": F.col("_tw_text")}
    if "n_chars" in docs.columns:
        counted = F.length("_tw_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(held, counted).otherwise(F.col("n_chars"))
    return changed.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
