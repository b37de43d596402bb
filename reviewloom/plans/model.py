"""The star schema that review measures are evaluated on, and its filters."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.dates import month_start
from reviewloom.operators.keys import hot_keys, join_split, restrict
from reviewloom.session import BROADCAST_ROWS, has_at_most

LABELLED = ("scene", "friction", "motivation")
SINGLE = ("time", "location")
BRIDGES = LABELLED + SINGLE

# Grouping column -> (owning table, column there).
OWNERS: dict[str, tuple[str, str]] = {
    **{f"{b}_{level}": (b, level) for b in LABELLED for level in ("main", "sub")},
    "time": ("time", "label"),
    "location": ("location", "label"),
    "month": ("reviews", "month"),
    "keyword": ("keyword", "keyword"),
    "brand": ("product", "brand"),
    "price": ("product", "price"),
    "price_band": ("product", "price_band"),
    "model": ("product", "model"),
    "asin": ("product", "asin"),
}


@dataclass(frozen=True)
class ReviewModel:
    """Bridges hold one row per (review_id, label); ``reviews`` is unique by review_id.

    reviews(review_id, rating, helpful, review_date[, clean_text, keywords]),
    scene/friction/motivation(review_id, main, sub), time/location(review_id, label),
    product_review(asin, review_id), product(asin, brand, price, price_band, model).
    """

    reviews: DataFrame
    scene: DataFrame
    friction: DataFrame
    motivation: DataFrame
    time: DataFrame
    location: DataFrame
    product_review: DataFrame | None = None
    product: DataFrame | None = None
    _hot: dict[str, list] = field(default_factory=dict, repr=False, compare=False)

    def bridge(self, name: str) -> DataFrame:
        return getattr(self, name)

    def filtered(self, reviews: Column | None = None, products: Column | None = None, **bridges: Column) -> ReviewModel:
        """Slicers. A review condition and a product condition both narrow the reviews; a condition on a
        bridge narrows that bridge alone and reaches reviews only through measures that use it."""
        out = self
        if reviews is not None:
            out = replace(out, reviews=out.reviews.where(reviews))
        if products is not None:
            chosen = out.product.where(products)
            links = restrict(out.product_review, chosen, "asin")
            out = replace(
                out, product=chosen, product_review=links, reviews=restrict(out.reviews, links, "review_id"), _hot={}
            )
        return replace(out, **{name: out.bridge(name).where(cond) for name, cond in bridges.items()})

    def ids(self, bridge: str) -> DataFrame:
        return self.bridge(bridge).select("review_id")

    def labels(self, bridge: str, columns: list[str]) -> tuple[DataFrame, str | None]:
        """The labels of each review at some level, so that a review counts once per group at any level.

        Whole labels are the rows of the bridge as they stand. At a coarser level each review gets one
        row with the set of its labels, in the second result's column: one shuffle by review both merges
        repeats and serves the join that follows. A set has at most as many members as there are labels.
        """
        source = {c: OWNERS[c][1] for c in columns}
        rows = self.bridge(bridge)
        if ({"label"} if bridge in SINGLE else {"main", "sub"}) <= set(source.values()):
            return rows.select("review_id", *[F.col(s).alias(c) for c, s in source.items()]), None
        group = F.struct(*[F.col(s).alias(c) for c, s in source.items()])
        return rows.groupBy("review_id").agg(F.collect_set(group).alias(f"_{bridge}")), f"_{bridge}"

    def label_sets(self, bridges: tuple[str, ...], by: list[str]) -> DataFrame:
        """One row per review that every named bridge holds, with the set of its labels of each bridge in ``by``.

        The set of a bridge is in the column ``_<bridge>``; ``by`` may name columns of bridges and of reviews.
        """
        plain = [c for c in by if OWNERS[c][0] not in BRIDGES]
        bare = tuple(b for b in bridges if b not in {OWNERS[c][0] for c in by})
        rows = self.scoped(bare, plain)
        for name in dict.fromkeys(OWNERS[c][0] for c in by if c not in plain):
            members = F.struct(*[F.col(OWNERS[c][1]).alias(c) for c in by if OWNERS[c][0] == name])
            rows = rows.join(self.bridge(name).groupBy("review_id").agg(F.collect_set(members).alias(f"_{name}")), "review_id")
        return rows

    def hot(self, key: str) -> list:
        """Products or reviews with a large part of all links, looked up once per model."""
        if key not in self._hot:
            self._hot[key] = hot_keys(self.product_review, key)
        return self._hot[key]

    def products(self, columns: list[str]) -> DataFrame:
        """Distinct (review_id, product columns); reviews and products are many to many."""
        if columns == ["asin"]:
            known = restrict(self.product_review, self.product, "asin")
            return known.select("review_id", "asin").distinct()
        wanted = self.product.select("asin", *[c for c in columns if c != "asin"])
        if has_at_most(wanted, BROADCAST_ROWS):
            linked = self.product_review.join(F.broadcast(wanted), "asin")
        else:
            linked = join_split(self.product_review, wanted, "asin", self.hot("asin"))
        return linked.select("review_id", *columns).distinct()

    def scoped(self, bridges: tuple[str, ...], by: list[str]) -> DataFrame:
        """One row per (group, review): reviews that every named bridge holds, under the grouping columns."""
        rows = self.reviews.withColumn("month", month_start(F.col("review_date")))
        if "keyword" in by:
            words = F.explode(F.array_distinct(F.split("keywords", ";"))).alias("keyword")
            rows = rows.where(F.col("keywords") != "").select("*", words)
        kept = [c for c in ("rating", "helpful") if c in rows.columns]
        kept += [c for c in by if OWNERS[c][0] in ("reviews", "keyword")]
        rows = rows.select("review_id", *kept)
        sets = []
        for name in bridges:
            columns = [c for c in by if OWNERS[c][0] == name]
            if not columns:
                rows = restrict(rows, self.ids(name), "review_id")
                continue
            labels, label_set = self.labels(name, columns)
            rows = rows.join(labels, "review_id")
            if label_set:
                sets.append(label_set)
            else:
                kept += columns
        for label_set in sets:
            others = sets[sets.index(label_set) + 1 :]
            members = [f.name for f in rows.schema[label_set].dataType.elementType]
            rows = rows.select("review_id", *kept, *others, F.inline(label_set))
            kept += members
        columns = [c for c in by if OWNERS[c][0] == "product"]
        if not columns:
            return rows
        # a review id that many products share has many links but few rows here
        return join_split(self.products(columns), rows, "review_id", self.hot("review_id"))
