"""First-match lookup: equal product and a title that contains the term, first by an explicit order."""

from __future__ import annotations

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Terms of one product that a title is searched for one by one; with more, one automaton finds them all in one pass.
SCANNED_TERMS = 50
# What a lookup may hold to be sent to every worker. An automaton takes some ten times its terms' bytes.
AUTOMATON_TERMS = 1_000_000
AUTOMATON_BYTES = 32 << 20

# Copies of a large lookup, so that one product's titles spread over as many tasks.
SALTS = 16

# Order of each lookup table. The category priority is text and sorts as text.
CATEGORY_ORDER = (("Term", "string"), ("Priority", "string"))
PARTS_ORDER = (("Term", "string"), ("Priority", "int"))
PATTERN_ORDER = (("Priority", "int"), ("Term", "string"))


def load_lookup(table: DataFrame, order: tuple[tuple[str, str], ...]) -> DataFrame:
    """(product, rank_key, term, type): lower-case terms with the order columns cast as declared."""
    table = table.withColumn("Term", F.lower("Term"))
    key = F.struct(*[F.col(c).try_cast(kind).alias(c) for c, kind in order], F.lower("Term").alias("tie"))
    return table.select(F.col("Product").alias("product"), key.alias("rank_key"), F.col("Term").alias("term"), F.col("Type").alias("type"))


def _safe(text: Column) -> Column:
    return F.trim(F.coalesce(text, F.lit("")))


def first_match(
    rows: DataFrame,
    lookup: DataFrame,
    title: str,
    product: str,
    unmatched: str,
    out: str,
    limit: int = AUTOMATON_TERMS,
    scanned: int = SCANNED_TERMS,
) -> DataFrame:
    """Add ``out``: the type of the first lookup entry that applies, else ``unmatched``.

    Three ways with one result: a product's few terms travel with the row; a lookup within the bounds becomes an
    automaton per product, whose work on a title does not depend on the number of terms; a larger one is joined.
    """
    sizes = lookup.groupBy("product").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("term") + F.octet_length("type")).alias("bytes"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("n").alias("most")).first()
    if total["n"] <= limit and total["bytes"] <= AUTOMATON_BYTES:
        if (total["most"] or 0) > scanned:
            found = _automaton_match(lookup)(_safe(F.col(product)), _safe(F.col(title)))
            return rows.withColumn(out, F.coalesce(found, F.lit(unmatched)))
        # one row per product with its ordered terms: no candidate rows are produced at all
        ordered = F.array_sort(F.collect_list(F.struct("rank_key", "term", "type")))
        terms = lookup.groupBy("product").agg(ordered.alias("_terms"))
        key = terms.withColumnRenamed("product", "_product")
        joined = rows.join(F.broadcast(key), _safe(F.col(product)) == F.col("_product"), "left")
        safe_title = _safe(F.col(title))
        hit = F.filter("_terms", lambda t: F.contains(safe_title, t["term"]))
        return joined.withColumn(out, F.coalesce(F.try_element_at(hit, F.lit(1))["type"], F.lit(unmatched))).drop(
            "_product", "_terms"
        )
    return rows.join(
        _shuffled_match(rows, lookup, title, product),
        (F.col(product).eqNullSafe(F.col("_p"))) & (F.col(title).eqNullSafe(F.col("_t"))),
        "left",
    ).withColumn(out, F.coalesce(F.col("_type"), F.lit(unmatched))).drop("_p", "_t", "_type")


def _automaton_match(lookup: DataFrame):
    """A function (product, title) -> type over Arrow batches.

    The entries, numbered in their order inside each product, go to the workers as one broadcast within the bounds;
    a worker builds a product's automaton when it first meets the product.
    """
    order = Window.partitionBy("product").orderBy("rank_key", "term", "type")
    ranked = lookup.where(F.col("product").isNotNull() & F.col("term").isNotNull()).select("product", "term", "type", F.row_number().over(order).alias("rank"))
    entries: dict[str, list[tuple[str, int, str | None]]] = {}
    for row in ranked.toLocalIterator():
        entries.setdefault(row["product"], []).append((row["term"], row["rank"], row["type"]))
    shared = lookup.sparkSession.sparkContext.broadcast(entries)
    built: dict[str, tuple] = {}

    def automaton(product: str) -> tuple:
        """The automaton, the rank of the empty term, and types by rank."""
        if product not in built:
            search, types, anywhere = ahocorasick.Automaton(), {}, None
            for term, rank, kind in shared.value.get(product, ()):
                types[rank] = kind
                if not term:
                    anywhere = rank if anywhere is None else min(rank, anywhere)
                elif rank < search.get(term, rank + 1):
                    search.add_word(term, rank)
            search.make_automaton()
            built[product] = (search if len(search) else None, anywhere, types)
        return built[product]

    @F.pandas_udf("string")
    def match(products: pd.Series, titles: pd.Series) -> pd.Series:
        out = []
        for product, title in zip(products, titles):
            search, anywhere, types = automaton(product)
            ranks = [] if anywhere is None else [anywhere]
            if search is not None:
                ranks += [rank for _, rank in search.iter(title)]
            out.append(types.get(min(ranks, default=None)))
        return pd.Series(out, dtype="object")

    return match


def _shuffled_match(rows: DataFrame, lookup: DataFrame, title: str, product: str) -> DataFrame:
    """Matched type per distinct (product, title); titles of one product are salted over tasks."""
    pairs = rows.select(F.col(product).alias("_p"), F.col(title).alias("_t")).distinct()
    salted = pairs.withColumn("_salt", F.pmod(F.xxhash64("_t"), F.lit(SALTS)).cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    match = (
        (_safe(F.col("_p")) == copies["product"])
        & (salted["_salt"] == copies["_salt"])
        & F.contains(_safe(F.col("_t")), copies["term"])
    )
    found = salted.join(copies, match)
    return found.groupBy("_p", "_t").agg(F.min(F.struct("rank_key", "type"))["type"].alias("_type"))
