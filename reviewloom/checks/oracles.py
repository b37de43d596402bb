"""For each registered query, SQL over the same tables that must return the same rows."""

from __future__ import annotations

from reviewloom.checks import small_taxonomy as small
from reviewloom.operators.tagging import label_patterns

PLACES = """FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

BAND = """CASE WHEN price IS NULL THEN NULL WHEN price < 50 THEN 'a.$50以下' WHEN price < 100 THEN 'b.$50-100'
  WHEN price < 150 THEN 'c.$100-150' WHEN price < 200 THEN 'd.$150-200' WHEN price < 250 THEN 'e.$200-250'
  WHEN price < 300 THEN 'f.$250-300' ELSE 'g.$300以上' END"""

VIEWS = {
    "reviews": """SELECT o_orderkey AS review_id, CAST(substr(o_orderpriority,1,1) AS INT) AS rating,
  CAST(floor(o_totalprice) AS BIGINT) % 50 AS helpful, CAST(o_orderdate AS DATE) AS review_date,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders""",
    "scene": "SELECT DISTINCT l_orderkey AS review_id, p_type AS main, p_brand AS sub FROM lineitem JOIN part ON l_partkey = p_partkey",
    "friction": """SELECT DISTINCT l_orderkey AS review_id, l_linestatus AS main,
  concat(l_linestatus, CAST(l_linenumber AS VARCHAR)) AS sub FROM lineitem WHERE l_returnflag = 'R'""",
    "motivation": f"SELECT DISTINCT l_orderkey AS review_id, r_name AS main, n_name AS sub {PLACES} WHERE l_discount >= 0.05",
    "time_of_day": """SELECT DISTINCT l_orderkey AS review_id, concat('Q', CAST(quarter(l_shipdate) AS VARCHAR)) AS label
  FROM lineitem WHERE l_tax >= 0.04""",
    "location": f"SELECT DISTINCT l_orderkey AS review_id, r_name AS label {PLACES} WHERE l_quantity >= 25",
    "product_review": "SELECT DISTINCT l_partkey AS asin, l_orderkey AS review_id FROM lineitem",
    "product": f"""SELECT asin, brand, price, {BAND} AS price_band, model FROM (SELECT p_partkey AS asin, p_brand AS brand,
  round((p_retailprice - 900) * 4, 2) AS price, p_type AS model FROM part)""",
    "listing": f"""SELECT *, {BAND} AS price_band FROM (
  SELECT p_partkey AS asin, p_brand AS brand, concat(p_brand, '-', CAST(p_size % 7 AS VARCHAR)) AS parent_asin,
    p_name AS title, p_type AS pattern, split_part(p_name, ' ', -1) AS parts, split_part(p_name, ' ', 1) AS product,
    (SELECT r_name FROM region WHERE r_regionkey = p_partkey % 5) AS seller_region,
    round((p_retailprice - 900) * 4, 2) AS price, 1.0 + (p_size % 9) * CAST(0.5 AS DOUBLE) AS rating,
    CAST(sum(l_quantity) AS BIGINT) AS monthly_units,
    CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS BIGINT) AS monthly_revenue,
    CAST(min(l_shipdate) AS DATE) AS listing_date,
    CASE WHEN p_partkey % 11 <> 0 THEN date_diff('day', CAST(min(l_shipdate) AS DATE), DATE '2002-01-01') END AS days_listed,
    count(*) AS rating_count
  FROM part JOIN lineitem ON l_partkey = p_partkey
  GROUP BY p_partkey, p_brand, p_size, p_name, p_type, p_retailprice)""",
    "raw": """SELECT concat(source, '_', CAST(doc_id AS VARCHAR)) AS Review_Key, doc_id - doc_id % 3 AS Review_ID, source AS ASIN,
  CASE WHEN n_chars % 6 > 0 THEN n_chars % 6 END AS Rating, text AS Clean_Text, n_chars % 40 AS Helpful_Votes,
  DATE '2024-01-01' + CAST(n_chars % 700 AS INT) AS Review_Date FROM documents""",
    "status": """SELECT doc_id AS Review_ID, CASE WHEN toxic = 0 THEN 'v1' ELSE 'v0' END AS Model_Version,
  CASE WHEN quality = 1 THEN 'SUCCESS' ELSE 'FAILED' END AS Processing_Status FROM labels""",
    "todo": """SELECT Review_ID, min(struct_pack(k := Review_Key, v := Clean_Text)).v AS Clean_Text,
  min(struct_pack(k := Review_Key, v := Rating)) FILTER (Rating IS NOT NULL).v AS Rating FROM raw
  WHERE Clean_Text IS NOT NULL AND NOT EXISTS (SELECT 1 FROM status s WHERE s.Review_ID = raw.Review_ID
    AND Processing_Status = 'SUCCESS' AND Model_Version = 'v1') GROUP BY Review_ID""",
    "delta": """SELECT Review_ID, 'v1' AS Model_Version,
  CASE WHEN length(Clean_Text) > 300 THEN 'SUCCESS' ELSE 'FAILED' END AS Processing_Status FROM todo""",
    "parents": """SELECT brand, parent_asin, max(monthly_units) AS u, max(monthly_revenue) AS r FROM listing GROUP BY ALL""",
    "brands": """SELECT brand, CAST(sum(u) AS BIGINT) AS monthly_units, CAST(sum(r) AS BIGINT) AS monthly_revenue FROM parents GROUP BY brand""",
    "seeds": """SELECT label, CAST(pos - 1 AS INT) AS pos, avg(x) AS x FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x,
  generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2""",
    "centroids": "SELECT label, list(x ORDER BY pos) AS vec FROM seeds GROUP BY label",
    "scored": """SELECT vec_id, CAST(c.label AS VARCHAR) AS label,
  list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.vec) AS sim FROM embeddings e, centroids c""",
    "best": """SELECT vec_id, arg_max(label, sim) AS best, max(sim) AS score, max(sim) - (max(sim, 2))[2] AS margin FROM scored GROUP BY vec_id""",
}

NEEDS = {
    "todo": ("raw", "status"),
    "delta": ("todo",),
    "parents": ("listing",),
    "brands": ("parents",),
    "centroids": ("seeds",),
    "scored": ("centroids",),
    "best": ("scored",),
}


def sql(body: str, *views: str, extra: str = "") -> str:
    """``body`` with the views it needs in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, ()):
            add(need)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    parts = [f"{name} AS ({VIEWS[name]})" for name in order] + ([extra] if extra else [])
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def level_stats(family: str, columns: list[str], source: str, level: int | None = None, nulls: list[str] = (), coverage: str = "") -> str:
    """Measures of one family at one level, from distinct (level, review) pairs."""
    keys = [f"{c.split('_')[1]} AS {c}" for c in columns]
    pairs = f"(SELECT DISTINCT {', '.join(['review_id', *keys])} FROM {source})"
    head = [f"CAST({level} AS INT) AS level"] if level is not None else []
    head += columns + [f"NULL AS {c}" for c in nulls]
    body = f"""count(*) AS {family}_reviews, CAST(sum(helpful) AS BIGINT) AS {family}_votes,
  round(CAST(sum(helpful) AS DOUBLE) / count(*), 6) AS {family}_vote_per_review, round(avg(rating), 6) AS {family}_avg_rating,
  round(stddev_pop(rating), 6) AS {family}_rating_stddev, round(stddev_pop(rating) / avg(rating), 6) AS {family}_rating_cv"""
    if coverage:
        body += f", round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM reviews), 6) AS {coverage}"
    group = f" GROUP BY {', '.join(columns)}" if columns else ""
    return f"SELECT {', '.join([*head, body])} FROM {pairs} JOIN reviews USING (review_id){group}"


def leveled(family: str, coverage: str = "") -> str:
    main, sub = f"{family}_main", f"{family}_sub"
    parts = [
        level_stats(family, [main, sub], family, 0, [], coverage),
        level_stats(family, [main], family, 1, [sub], coverage),
        level_stats(family, [], family, 2, [main, sub], coverage),
    ]
    names = ["level", main, sub, f"{family}_reviews", f"{family}_votes", f"{family}_vote_per_review", f"{family}_avg_rating"]
    names += [f"{family}_rating_stddev", f"{family}_rating_cv"] + ([coverage] if coverage else [])
    return sql(" UNION ALL ".join(f"SELECT {', '.join(names)} FROM ({p})" for p in parts), "reviews", family)


MONTHLY = """SELECT {keys}month, all_reviews, friction_reviews, friction_rate_pct, friction_mom_pct, friction_yoy_pct,
  friction_pct_rolling18m FROM (
  SELECT {keys}month, all_reviews, friction_reviews, round(rate, 6) AS friction_rate_pct,
    round((rate - prev) / prev, 6) AS friction_mom_pct, round((rate - year) / year, 6) AS friction_yoy_pct,
    round(CAST(t AS DOUBLE) / a, 6) AS friction_pct_rolling18m
  FROM (SELECT m.*, (SELECT rate FROM monthly p WHERE p.idx = m.idx - 1 {same}) AS prev,
      (SELECT rate FROM monthly p WHERE p.idx = m.idx - 12 {same}) AS year,
      (SELECT sum(friction_reviews) FROM monthly p WHERE p.idx BETWEEN m.idx - 17 AND m.idx {same}) AS t,
      (SELECT sum(all_reviews) FROM monthly p WHERE p.idx BETWEEN m.idx - 17 AND m.idx {same}) AS a FROM monthly m))"""


def monthly(keys: str = "", source: str = "reviews") -> str:
    same = "AND p.model = m.model" if keys else ""
    base = f"""monthly AS (SELECT *, CAST(friction_reviews AS DOUBLE) / all_reviews AS rate FROM (
  SELECT {keys}month, year(month) * 12 + month(month) AS idx, count(*) AS all_reviews,
    nullif(count(f.review_id), 0) AS friction_reviews
  FROM {source} LEFT JOIN (SELECT DISTINCT review_id FROM friction) f USING (review_id) GROUP BY ALL))"""
    return base, MONTHLY.format(keys=keys, same=same)


def found(pattern: str, text: str = "text") -> str:
    return f"regexp_matches({text}, '(?i){pattern}')"


def tags(family: str, extra: dict[str, str] | None = None) -> str:
    """One SELECT per label of a family over the documents."""
    extra = extra or {}
    return " UNION ALL ".join(
        f"SELECT doc_id, n_chars, '{main}' AS main, '{sub}' AS sub FROM documents "
        f"WHERE trim(text) <> '' AND {found(pattern)} {extra.get(sub, '')}"
        for main, sub, pattern, _ in label_patterns(small.RULES, family)
    )


STARS = "CASE WHEN n_chars % 6 > 0 THEN n_chars % 6 END"
FRICTION_TAGS = tags(
    "friction",
    {
        "License": f"AND NOT (n_chars % 6 >= 4 AND {found(small.WITHDRAW_LICENSE)})",
        "Numbers": f"AND NOT {found(small.WITHDRAW_NUMBERS)}",
    },
)

BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def clean(col: str) -> str:
    out = f"regexp_replace({col}, '<[^>]*>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''")):
        out = f"replace({out}, '{entity}', '{char}')"
    for mark in "‘’´`":
        out = f"replace({out}, '{mark}', '''')"
    for mark in "“”":
        out = f"replace({out}, '{mark}', '\"')"
    return f"trim(regexp_replace({out}, '{BLANKS}', ' ', 'g'))"


def text_list(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


# What the keyword queries must leave out, said here once more and not taken from the library.
LEFT_OUT = """a about above after again all also am an and any are as at be because been before being below
    between both but by can could did do does doing down during each eight eighty eleven few fifty five
    for forty four from further had has have having he her here hers him his how hundred i if in into is
    it its itself just me million more most my nine ninety no nor not now of off on once one only or
    other our out over own same seven seventy she should six sixty so some such ten than that the their
    them then there these they thirty this those thousand three through to too twelve twenty two under
    until up us very was we were what when where which while who whom why will with would you your zero""".split()
SHORT_KEPT = """emf ems fir ir led nmp red rf uv""".split()
WORDS = """SELECT {key}, CASE WHEN w = 'lytion' AND {mapped} THEN 'ly' ELSE w END AS w, pos FROM (
  SELECT {key}, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM (SELECT {key}, [
    regexp_replace(x, chr(39) || '(s|re|ve|ll|d|m)$', '') FOR x IN
    regexp_extract_all(translate(lower({text}), chr(8217) || chr(700), chr(39) || chr(39)), '[\\p{{L}}\\p{{N}}]+(?:''\\p{{L}}+)*')
    IF NOT regexp_matches(x, 'n''t$')] AS ws FROM {table}))
  WHERE w NOT IN {left_out} AND NOT regexp_matches(w, '^\\p{{N}}+$')"""


def words(key: str, text: str, table: str, mapped: str) -> str:
    inner = WORDS.format(key=key, text=text, table=table, mapped=mapped, left_out=text_list(LEFT_OUT))
    return f"words AS (SELECT * FROM ({inner}) WHERE length(w) >= 3 OR w IN {text_list(SHORT_KEPT)})"


LINES = "lookup AS (SELECT DISTINCT p_type AS product, lower(term) AS term, concat(lower(term), ':', CAST(pr AS VARCHAR)) AS type, pr FROM ("
LOOKUP = (
    LINES + "SELECT p_type, split_part(p_name, ' ', -1) AS term, 2 AS pr FROM part UNION ALL "
    "SELECT p_type, split_part(p_name, ' ', 1), 1 FROM part) WHERE length(term) > 3)"
)


def first(order: str, product: str, title: str) -> str:
    return f"""(SELECT l.type FROM lookup l WHERE {product} AND contains({title}, l.term) ORDER BY {order}, l.type LIMIT 1)"""


def share(top: str, bottom: str) -> str:
    return f"round(CAST({top} AS DOUBLE) / {bottom}, 6)"


RUNNING = """ranked AS (SELECT *, sum(monthly_revenue) OVER (ORDER BY monthly_revenue DESC, brand ROWS UNBOUNDED PRECEDING) AS cum,
  sum(monthly_revenue) OVER () AS total, rank() OVER (ORDER BY monthly_revenue DESC) AS rr,
  dense_rank() OVER (ORDER BY monthly_units DESC) AS du, dense_rank() OVER (ORDER BY monthly_revenue DESC) AS dr,
  count(*) OVER () AS n FROM brands)"""
TOP_UNITS = "(monthly_units > 0 AND (du <= 5 OR CAST(du AS DOUBLE) / n <= 0.05))"
TOP_REVENUE = "(monthly_revenue > 0 AND (dr <= 5 OR CAST(dr AS DOUBLE) / n <= 0.05))"

MARKET_CELLS = {
    "monthly_units": "CAST(sum(u) AS BIGINT)",
    "monthly_revenue": "CAST(sum(r) AS BIGINT)",
    "rating_count": "CAST(sum(c) AS BIGINT)",
}


def market_level(level: int, columns: list[str]) -> str:
    """Brand matrix at one level."""
    group = "".join(f"{c}, " for c in columns)
    by = f"GROUP BY {', '.join(columns)}" if columns else ""
    same = " AND ".join(f"l.{c} = t.{c}" for c in columns) or "true"
    nulls = "".join(f"CAST(NULL AS {kind}) AS {c}, " for c, kind in (("brand", "VARCHAR"), ("asin", "BIGINT")) if c not in columns)
    rank = {2: "rank() OVER (PARTITION BY asin ORDER BY sum(r) DESC)", 1: "rank() OVER (ORDER BY sum(r) DESC)", 0: "CAST(NULL AS BIGINT)"}[len(columns)]
    # the inner brand is renamed so that it does not clash with a grouping brand
    inner = f"""SELECT {group}brand AS b, parent_asin, max(monthly_units) AS u, max(monthly_revenue) AS r, max(rating_count) AS c,
    min(listing_date) AS d, sum(price) AS ps, count(price) AS pn FROM listing GROUP BY ALL"""
    return f"""SELECT CAST({level} AS INT) AS level, {nulls}{group}CAST(sum(u) AS BIGINT) AS monthly_units, CAST(sum(r) AS BIGINT) AS monthly_revenue,
  round(sum(ps) / sum(pn), 6) AS avg_price, (SELECT round(median(l.price), 6) FROM listing l WHERE {same}) AS median_price,
  {share('sum(r)', '(SELECT sum(r) FROM parents)')} AS brand_market_share,
  (SELECT round(median(l.rating), 6) FROM listing l WHERE {same}) AS median_listing_rating,
  CAST(sum(c) AS BIGINT) AS rating_count,
  DATE '1970-01-01' + CAST(floor(median(date_diff('day', DATE '1970-01-01', d)) FILTER (d > DATE '2000-01-01')) AS INT) AS median_listing_date,
  {rank} AS revenue_rank FROM ({inner}) t {by}"""


def matrix(*levels: list[str]) -> str:
    names = """level, brand, asin, monthly_units, monthly_revenue, avg_price, median_price, brand_market_share, median_listing_rating,
    rating_count, median_listing_date, revenue_rank"""
    return " UNION ALL ".join(f"SELECT {names} FROM ({market_level(i, c)})" for i, c in enumerate(levels))


SCENE_FRICTION = "sf AS (SELECT review_id, s.main AS sm, f.main AS fm, f.sub AS fs FROM scene s JOIN friction f USING (review_id) JOIN reviews USING (review_id))"
M2M = """links AS (SELECT DISTINCT review_id, brand FROM product_review JOIN product USING (asin))"""
PRODUCT_CHOICE = "((brand = 'Brand#1' AND model = 'ECONOMY') OR (brand = 'Brand#2' AND model = 'PROMO')) AND price BETWEEN 50 AND 300"


def review_row(source: str) -> str:
    return f"""SELECT {source} count(*) AS all_reviews, round(avg(rating), 6) AS all_rating, CAST(sum(helpful) AS BIGINT) AS all_votes,
  nullif(count(f.review_id), 0) AS friction_reviews, round(CAST(nullif(count(f.review_id), 0) AS DOUBLE) / count(*), 6) AS friction_coverage_pct,
  CAST(median(rating) AS DOUBLE) AS mrating"""


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    base, body = monthly()
    o["friction_rate_monthly"] = sql(body, "reviews", "friction", extra=base)
    o["monthly_line"] = sql(
        f"SELECT strftime(month, '%Y-%m') AS month, friction_rate_pct, friction_pct_rolling18m FROM ({body})", "reviews", "friction", extra=base
    )
    by_model, body = monthly(
        "model, ", "(SELECT DISTINCT review_id, month, model FROM reviews JOIN product_review USING (review_id) JOIN product USING (asin))"
    )
    o["friction_rate_monthly_by_model"] = sql(body, "reviews", "friction", "product_review", "product", extra=by_model)

    cover = "scene_review_coverage_pct"
    o["scene_measures_main"] = sql(level_stats("scene", ["scene_main"], "scene", coverage=cover), "reviews", "scene")
    o["scene_measures_sub"] = sql(level_stats("scene", ["scene_main", "scene_sub"], "scene", coverage=cover), "reviews", "scene")
    o["scene_measures_total"] = sql(level_stats("scene", [], "scene", coverage=cover), "reviews", "scene")
    o["friction_matrix_levels"] = leveled("friction")
    o["motivation_matrix_levels"] = leveled("motivation", "motivation_coverage_pct")

    o["scene_friction_matrix"] = sql(
        """SELECT CAST(0 AS INT) AS level, sm AS scene_main, fm AS friction_main, count(DISTINCT review_id) AS scene_friction_reviews FROM sf GROUP BY sm, fm
        UNION ALL SELECT 1, sm, NULL, count(DISTINCT review_id) FROM sf GROUP BY sm
        UNION ALL SELECT 2, NULL, fm, count(DISTINCT review_id) FROM sf GROUP BY fm
        UNION ALL SELECT 3, NULL, NULL, count(DISTINCT review_id) FROM sf""",
        "reviews", "scene", "friction", extra=SCENE_FRICTION,
    )
    o["motivation_friction_matrix"] = sql(
        """SELECT m.main AS motivation_main, m.sub AS motivation_sub, f.main AS friction_main, f.sub AS friction_sub,
        count(DISTINCT review_id) AS motivation_friction_reviews FROM motivation m JOIN friction f USING (review_id)
        JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "motivation", "friction",
    )
    o["location_friction_matrix"] = sql(
        """SELECT label AS location, f.main AS friction_main, count(DISTINCT review_id) AS location_friction_reviews
        FROM location JOIN friction f USING (review_id) JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "location", "friction",
    )
    o["scene_time_location"] = sql(
        """SELECT s.main AS scene_main, l.label AS location, t.label AS time, count(DISTINCT review_id) AS scene_reviews_time_location
        FROM scene s JOIN location l USING (review_id) JOIN time_of_day t USING (review_id) JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "scene", "location", "time_of_day",
    )
    o["motivation_time_location"] = sql(
        """SELECT m.main AS motivation_main, t.label AS time, count(DISTINCT review_id) AS motivation_reviews_time_location
        FROM motivation m JOIN time_of_day t USING (review_id) JOIN reviews USING (review_id)
        WHERE review_id IN (SELECT review_id FROM location) GROUP BY ALL""",
        "reviews", "motivation", "location", "time_of_day",
    )
    o["friction_in_time"] = sql(
        """SELECT f.sub AS friction_sub, nullif(count(DISTINCT CASE WHEN review_id IN (SELECT review_id FROM time_of_day) THEN review_id END), 0)
        AS friction_reviews_time, count(DISTINCT review_id) AS friction_reviews FROM friction f JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "friction", "time_of_day",
    )
    o["location_friction_share"] = sql(
        """SELECT label AS location, count(DISTINCT review_id) AS location_reviews, nullif(count(DISTINCT f.review_id), 0) AS location_friction_reviews,
        round(CAST(nullif(count(DISTINCT f.review_id), 0) AS DOUBLE) / count(DISTINCT review_id), 6) AS location_friction_pct
        FROM location JOIN reviews USING (review_id) LEFT JOIN friction f USING (review_id) GROUP BY ALL""",
        "reviews", "location", "friction",
    )
    tagged = "LEFT JOIN (SELECT DISTINCT review_id FROM friction) f USING (review_id)"
    o["brand_reviews_m2m"] = sql(
        f"""{review_row("CAST(0 AS INT) AS level, brand,")} FROM links JOIN reviews USING (review_id) {tagged} GROUP BY brand
        UNION ALL {review_row("CAST(1 AS INT) AS level, NULL AS brand,")} FROM reviews {tagged}""",
        "reviews", "friction", "product_review", "product", extra=M2M,
    )
    o["product_tree"] = sql(
        """SELECT CAST(level AS INT) AS level, friction_main, friction_sub, brand, count(*) AS friction_reviews, CAST(sum(helpful) AS BIGINT) AS friction_votes FROM (
        SELECT DISTINCT 0 AS level, NULL AS friction_main, NULL AS friction_sub, NULL AS brand, review_id FROM friction
        UNION ALL SELECT DISTINCT 1, main, NULL, NULL, review_id FROM friction
        UNION ALL SELECT DISTINCT 2, main, sub, NULL, review_id FROM friction
        UNION ALL SELECT DISTINCT 3, main, sub, brand, review_id FROM friction JOIN links USING (review_id))
        JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "friction", "product_review", "product", extra=M2M,
    )
    o["product_slicer"] = sql(
        f"""SELECT brand, count(*) AS all_reviews, nullif(count(f.review_id), 0) AS friction_reviews,
        round(CAST(nullif(count(f.review_id), 0) AS DOUBLE) / count(*), 6) AS friction_rate_pct
        FROM (SELECT DISTINCT review_id, brand FROM product_review JOIN product USING (asin) WHERE {PRODUCT_CHOICE})
        JOIN reviews USING (review_id) {tagged} WHERE review_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY brand""",
        "reviews", "friction", "product_review", "product",
    )
    o["flow_edges"] = sql(
        """SELECT CAST(0 AS INT) AS step, sm AS source, fm AS target, count(DISTINCT review_id) AS reviews FROM sf GROUP BY ALL
        UNION ALL SELECT 1, fm, fs, count(DISTINCT review_id) FROM sf GROUP BY ALL""",
        "reviews", "scene", "friction", extra=SCENE_FRICTION,
    )
    o["category_rank_by_month"] = sql(
        """SELECT *, CAST(rank() OVER (PARTITION BY month ORDER BY scene_reviews DESC) AS INT) AS place FROM (
        SELECT month, main AS scene_main, count(DISTINCT review_id) AS scene_reviews FROM reviews JOIN scene USING (review_id) GROUP BY ALL)""",
        "reviews", "scene",
    )
    cards = ", ".join(
        f"round((SELECT CAST(count(DISTINCT review_id) AS DOUBLE) FROM {t} JOIN reviews USING (review_id)) / (SELECT count(*) FROM reviews), 6) AS {n}"
        for t, n in (("scene", cover), ("friction", "friction_coverage_pct"), ("motivation", "motivation_coverage_pct"))
    )
    o["kpi_cards"] = sql(f"SELECT (SELECT count(*) FROM reviews) AS all_reviews, {cards}", "reviews", "scene", "friction", "motivation")
    o["rating_stats"] = sql(
        """SELECT count(DISTINCT review_id) AS all_reviews, round(avg(rating), 6) AS all_rating, round(stddev_pop(rating), 6) AS all_rating_stddev,
        CAST(sum(helpful) AS BIGINT) AS all_votes, CAST(median(rating) AS DOUBLE) AS mrating FROM reviews""",
        "reviews",
    )
    o["two_level_bars"] = sql(
        "SELECT main AS motivation_main, sub AS motivation_sub, count(DISTINCT review_id) AS motivation_reviews FROM motivation JOIN reviews USING (review_id) GROUP BY ALL",
        "reviews", "motivation",
    )
    o["scatter_by_tag"] = sql(
        """SELECT scene_sub, count(*) AS scene_reviews, CAST(sum(helpful) AS BIGINT) AS scene_votes, round(CAST(sum(helpful) AS DOUBLE) / count(*), 6) AS scene_vote_per_review
        FROM (SELECT DISTINCT sub AS scene_sub, review_id FROM scene) JOIN reviews USING (review_id) GROUP BY ALL""",
        "reviews", "scene",
    )
    o["review_drillthrough"] = sql(
        """SELECT review_id, rating, helpful, review_date FROM reviews WHERE review_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
        AND review_id IN (SELECT review_id FROM scene WHERE main = 'ECONOMY' INTERSECT SELECT review_id FROM friction WHERE main = 'O')""",
        "reviews", "scene", "friction",
    )
    o["calendar"] = sql(
        """SELECT d AS "Date", CAST(year(d) AS INT) AS "Year", CAST(month(d) AS INT) AS "MonthNo", monthname(d) AS "Month", CAST(quarter(d) AS INT) AS "QuarterNo",
        concat('Qtr ', CAST(quarter(d) AS VARCHAR)) AS "Quarter", CAST(day(d) AS INT) AS "Day", CAST(date_trunc('month', d) AS DATE) AS "Year_Month",
        CAST(year(d) * 100 + month(d) AS INT) AS "MY_Order" FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
        INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(review_date) AS lo, max(review_date) AS hi FROM reviews))""",
        "reviews",
    )
    o["calendar_gaps"] = sql(
        """SELECT m AS "Year_Month", n AS reviews, t AS tagged_reviews, round(a, 6) AS avg_rating FROM (
        SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 11 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m
        FROM (SELECT min(review_date) AS lo, max(review_date) AS hi FROM reviews)) LEFT JOIN (
        SELECT month AS m, count(*) AS n, count(f.review_id) AS c, nullif(count(f.review_id), 0) AS t, avg(rating) AS a FROM reviews
        LEFT JOIN (SELECT DISTINCT review_id FROM friction) f USING (review_id) WHERE rating = 1 AND helpful = 7 GROUP BY month) USING (m)
        WHERE year(m) BETWEEN 1994 AND 1997 AND month(m) <= 6""",
        "reviews", "friction",
    )
    o["month_windows"] = sql(
        """SELECT month, CAST(month - INTERVAL 17 MONTH AS DATE) AS window_start, last_day(month) AS window_end,
        CAST(month - INTERVAL 1 MONTH AS DATE) AS month_before, CAST(month - INTERVAL 12 MONTH AS DATE) AS year_before FROM (SELECT DISTINCT month FROM reviews)""",
        "reviews",
    )

    # listing measures
    o["brand_market"] = sql(
        """SELECT brand, monthly_units, monthly_revenue, rating_count, rr AS revenue_rank, rr <= 10 AS is_top10_brand FROM ranked JOIN (
        SELECT brand, CAST(sum(c) AS BIGINT) AS rating_count FROM (SELECT brand, parent_asin, max(rating_count) AS c FROM listing GROUP BY ALL) GROUP BY brand) USING (brand)""",
        "brands", extra=RUNNING,
    )
    o["pareto_top15"] = sql(
        f"""SELECT brand, monthly_revenue, CAST(cum AS BIGINT) AS cumulative_revenue, {share('cum', 'total')} AS pareto_share
        FROM ranked ORDER BY monthly_revenue DESC, brand LIMIT 15""",
        "brands", extra=RUNNING,
    )
    priced = """picked AS (SELECT * FROM listing WHERE price BETWEEN 100 AND 250), pb AS (SELECT brand, sum(r) AS monthly_revenue FROM (
        SELECT brand, parent_asin, max(monthly_revenue) AS r FROM picked GROUP BY ALL) GROUP BY brand)"""
    o["pareto_combo"] = sql(
        f"""SELECT brand, CAST(monthly_revenue AS BIGINT) AS monthly_revenue,
        {share('sum(monthly_revenue) OVER (ORDER BY monthly_revenue DESC, brand ROWS UNBOUNDED PRECEDING)', 'sum(monthly_revenue) OVER ()')} AS pareto_share
        FROM pb ORDER BY monthly_revenue DESC, brand LIMIT 15""",
        "listing", extra=priced,
    )
    o["top15_brand_listings"] = sql(
        "SELECT asin, brand, price_band FROM listing WHERE brand IN (SELECT brand FROM brands ORDER BY monthly_revenue DESC, brand LIMIT 15)", "brands"
    )
    o["top_brand_flags"] = sql(
        f"SELECT brand, CAST({TOP_UNITS} AS INT) AS is_top_brand_units, CAST({TOP_REVENUE} AS INT) AS is_top_brand_revenue, rr AS revenue_rank FROM ranked",
        "brands", extra=RUNNING,
    )
    o["top_brand_share"] = sql(
        f"""SELECT sum(CAST({TOP_UNITS} AS BIGINT))::BIGINT AS top_brand_count,
        {share(f'sum(monthly_units) FILTER ({TOP_UNITS})', 'sum(monthly_units)')} AS top_brand_unit_share,
        {share(f'sum(monthly_revenue) FILTER ({TOP_REVENUE})', 'sum(monthly_revenue)')} AS top_brand_revenue_share FROM ranked""",
        "brands", extra=RUNNING,
    )
    o["top3_parts"] = sql(
        """SELECT parts, NULL AS brand, CAST(sum(r) AS BIGINT) AS monthly_revenue, rank() OVER (ORDER BY sum(r) DESC) AS revenue_rank,
        rank() OVER (ORDER BY sum(r) DESC) <= 3 AS is_top3_in_scope FROM pp GROUP BY parts
        UNION ALL SELECT parts, brand, CAST(sum(r) AS BIGINT), rank() OVER (PARTITION BY parts ORDER BY sum(r) DESC),
        rank() OVER (PARTITION BY parts ORDER BY sum(r) DESC) <= 3 FROM pp GROUP BY parts, brand""",
        "listing", extra="pp AS (SELECT parts, brand, parent_asin, max(monthly_revenue) AS r FROM listing GROUP BY ALL)",
    )
    o["price_band_profile"] = sql(
        f"""SELECT price_band, count(DISTINCT brand) AS brand_count, {share('sum(u)', '(SELECT sum(u) FROM parents)')} AS band_unit_share,
        {share('sum(r)', '(SELECT sum(r) FROM parents)')} AS band_revenue_share FROM (
        SELECT price_band, brand, parent_asin, max(monthly_units) AS u, max(monthly_revenue) AS r FROM listing GROUP BY ALL) GROUP BY price_band""",
        "parents",
    )
    o["share_ignoring_brand"] = sql(
        f"""SELECT pattern, brand, CAST(u AS BIGINT) AS monthly_units, {share('u', 'pu')} AS unit_share_all_brands, {share('r', 'prv')} AS revenue_share_all_brands FROM (
        SELECT *, sum(u) OVER (PARTITION BY pattern) AS pu, sum(r) OVER (PARTITION BY pattern) AS prv FROM (
        SELECT pattern, brand, sum(u) AS u, sum(r) AS r FROM (SELECT pattern, brand, parent_asin, max(monthly_units) AS u, max(monthly_revenue) AS r
        FROM listing GROUP BY ALL) GROUP BY ALL)) WHERE brand IN ('Brand#1', 'Brand#2', 'Brand#3')""",
        "listing",
    )
    o["share_selected"] = sql(
        f"""SELECT seller_region, pattern, CAST(sum(r) AS BIGINT) AS monthly_revenue, {share('sum(r)', '(SELECT sum(r) FROM (SELECT brand, parent_asin, max(monthly_revenue) AS r FROM picked GROUP BY ALL))')} AS brand_market_share
        FROM (SELECT seller_region, pattern, brand, parent_asin, max(monthly_revenue) AS r FROM picked GROUP BY ALL) GROUP BY ALL""",
        "listing", extra="picked AS (SELECT * FROM listing WHERE price < 200)",
    )
    o["listing_age_median"] = sql(
        """SELECT brand, DATE '1970-01-01' + CAST(floor(median(date_diff('day', DATE '1970-01-01', d)) FILTER (d > DATE '2000-01-01')) AS INT) AS median_listing_date
        FROM (SELECT brand, parent_asin, min(listing_date) AS d FROM listing GROUP BY ALL) GROUP BY brand""",
        "listing",
    )
    o["days_listed_median"] = sql(
        """SELECT brand, CAST(median(d) AS DOUBLE) AS median_days_listed FROM (SELECT brand, parent_asin, max(days_listed) AS d FROM listing
        WHERE price < 200 AND days_listed IS NOT NULL GROUP BY ALL) GROUP BY brand""",
        "listing",
    )
    o["brand_price_stats"] = sql(
        """SELECT brand, round(avg(price), 6) AS avg_price, round(median(price), 6) AS median_price, round(avg(rating), 6) AS avg_listing_rating,
        round(median(rating), 6) AS median_listing_rating FROM listing GROUP BY brand""",
        "listing",
    )
    o["market_kpis"] = sql(
        """SELECT CAST(sum(u) AS BIGINT) AS monthly_units, CAST(sum(r) AS BIGINT) AS monthly_revenue, count(DISTINCT brand) AS brand_count,
        round(CAST(sum(r) AS DOUBLE) / count(DISTINCT brand), 6) AS avg_revenue_per_brand, CAST(sum(c) AS BIGINT) AS rating_count,
        (SELECT round(median(price), 6) FROM listing) AS median_price FROM (
        SELECT brand, parent_asin, max(monthly_units) AS u, max(monthly_revenue) AS r, max(rating_count) AS c FROM listing GROUP BY ALL)""",
        "listing",
    )
    o["brand_asin_matrix"] = sql(matrix(["brand", "asin"], ["brand"], []), "parents")
    o["region_pattern"] = sql(
        f"""SELECT seller_region, pattern, CAST(sum(r) AS BIGINT) AS monthly_revenue, {share('sum(r)', '(SELECT sum(r) FROM parents)')} AS brand_market_share
        FROM (SELECT seller_region, pattern, brand, parent_asin, max(monthly_revenue) AS r FROM listing GROUP BY ALL) GROUP BY ALL""",
        "parents",
    )

    # text
    o["clean_html_text"] = f"SELECT page_id, {clean('html')} AS clean_text FROM pages"
    o["extract_ids"] = """SELECT page_id, rid AS review_id, '' AS no_id, asin, 'Mask' AS product, concat(asin, '_', rid) AS review_key FROM (
        SELECT page_id, CASE WHEN page_id % 4 > 0 THEN concat('R', CAST(page_id AS VARCHAR)) ELSE '' END AS rid, concat('B0', CAST(page_id AS VARCHAR)) AS asin FROM pages)"""
    o["coerce_types"] = """SELECT event_id, CASE WHEN b IN (0, 1, 2) THEN NULL ELSE CAST(n AS BIGINT) END AS rating,
        CASE WHEN b IN (0, 1, 2) THEN CAST(0 AS BIGINT) ELSE CAST(n AS BIGINT) END AS votes, CASE WHEN b = 3 THEN NULL ELSE CAST(ts AS DATE) END AS day
        FROM (SELECT event_id, event_id % 7 AS b, regexp_extract(props, '([0-9]+)', 1) AS n, ts FROM events)"""
    kinds = [("Review_Key", "string"), ("Review_ID", "bigint"), ("ASIN", "string"), ("Rating", "bigint"), ("Clean_Text", "string"), ("Helpful_Votes", "bigint"), ("Review_Date", "date")]
    o["null_profile"] = sql(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS type, count(*) AS rows, count(*) - count({c}) AS nulls FROM raw" for c, k in kinds), "raw"
    )
    o["load_sample"] = sql("SELECT * FROM raw ORDER BY Review_Key LIMIT 3", "raw")
    o["title_normalise"] = """SELECT p_partkey, tb AS title_bullets, contains(tb, 'red') AS has_red, contains(tb, 'RED') AS has_upper_red FROM (
        SELECT p_partkey, lower(concat_ws(';', p_name, CASE WHEN p_partkey % 4 > 0 THEN p_type END)) AS tb FROM part)"""
    o["try_casts"] = """SELECT event_id, CAST(NULL AS BIGINT) AS word, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS number,
        TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS whole, CAST(ts AS DATE) AS day FROM events"""
    o["ordered_label"] = """SELECT p_partkey, CASE WHEN contains(n, 'red') OR contains(n, 'scarlet') THEN 'Red' WHEN contains(n, 'small') THEN 'Small'
        WHEN contains(n, 'widget') THEN 'Widget' ELSE 'Other' END AS label FROM (SELECT p_partkey, lower(p_name) AS n FROM part)"""
    by_priority = first("l.pr, l.term", "l.product = p_type", "p_name")
    by_term = first("l.term, l.pr", "l.product = p_type", "p_name")
    o["first_match_lookup"] = sql(
        f"""SELECT p_partkey, coalesce({by_priority}, 'none') AS by_priority,
        CASE WHEN p_type = 'ECONOMY' THEN 'fixed' ELSE coalesce({by_term}, 'none') END AS by_term FROM part""",
        extra=LOOKUP,
    )
    match = first("l.pr, l.term", "true", "title")
    o["listing_prep"] = sql(
        f"""SELECT asin, title_bullets, CASE WHEN k = 0 THEN 'FIR' WHEN k = 1 THEN 'RLT' ELSE 'Other' END AS is_infrared,
        coalesce({match}, '人类') AS cat, coalesce({match}, '全身') AS parts, coalesce({match}, '其它') AS pattern, {BAND} AS price_band,
        round(p_size / 100.0, 6)::DOUBLE AS review_rate, CAST(NULL AS BIGINT) AS sub_rank, CAST(p_size AS BIGINT) AS monthly_units FROM (
        SELECT CAST(p_partkey AS VARCHAR) AS asin, lower(p_name) AS title, p_partkey % 3 AS k, p_size, round((p_retailprice - 900) * 4, 2) AS price,
        concat_ws(';', lower(p_name), CASE p_partkey % 3 WHEN 0 THEN 'far infrared' WHEN 1 THEN 'red-light, soft' END) AS title_bullets
        FROM part WHERE p_partkey % 10 > 0)""",
        extra=LOOKUP,
    )
    o["keyword_bag"] = sql(
        "SELECT doc_id, coalesce(k, '') AS keywords FROM documents LEFT JOIN (SELECT doc_id, string_agg(w, ';' ORDER BY pos) AS k FROM words GROUP BY doc_id) USING (doc_id)",
        extra=words("doc_id", "text", "documents", "true"),
    )
    o["keyword_forms"] = sql(
        """SELECT doc_id, coalesce(k, '') AS keywords FROM documents LEFT JOIN (SELECT doc_id, string_agg(w, ';' ORDER BY pos) AS k FROM (
        SELECT doc_id, pos, CASE WHEN w LIKE '%ion' AND length(w) >= 7 THEN w[:-4] ELSE w END AS w FROM words) GROUP BY doc_id) USING (doc_id)""",
        extra=words("doc_id", "text", "documents", "false"),
    )
    o["bitmap_levels"] = sql(
        " UNION ALL ".join(
            f"SELECT CAST({n} AS INT) AS level, {m} AS main, {b} AS sub, count(DISTINCT review_id) AS reviews FROM scene{g}"
            for n, m, b, g in ((0, "main", "sub", " GROUP BY main, sub"), (1, "main", "NULL", " GROUP BY main"), (2, "NULL", "NULL", ""))
        ),
        "scene",
    )
    o["keyword_top150"] = sql(
        """SELECT w AS word, count(DISTINCT Review_ID) AS reviews, count(*) AS terms FROM words GROUP BY w ORDER BY reviews DESC, word LIMIT 150""",
        "raw", extra=words("Review_ID", "Clean_Text", "raw", "false"),
    )

    # tagging
    o["regex_tag_bridge"] = f"SELECT doc_id AS Review_ID, main AS Main_Scene, sub AS Sub_Scene FROM ({tags('scene')})"
    o["suppressed_tags"] = f"SELECT doc_id AS Review_ID, main AS Friction_Main, sub AS Friction_Sub, 'Regex' AS Friction_Source FROM ({FRICTION_TAGS})"
    o["time_location_tags"] = " UNION ALL ".join(f"SELECT doc_id AS Review_ID, '{f}' AS family, sub AS label FROM ({tags(f)})" for f in ("time", "location"))
    o["tag_coverage"] = f"""SELECT n AS reviews, s AS with_scene, f AS with_friction, {share('s', 'n')} AS scene_pct, {share('f', 'n')} AS friction_pct FROM (
        SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(DISTINCT doc_id) FROM ({tags('scene')})) AS s,
        (SELECT count(DISTINCT doc_id) FROM ({FRICTION_TAGS})) AS f)"""
    counts = ", ".join(
        f"(SELECT count(*) FROM ({FRICTION_TAGS if f == 'friction' else tags(f)})) AS {f}s_rows" for f in ("scene", "friction", "motivation", "time", "location")
    )
    o["run_summary"] = f"SELECT count(*) AS reviews, count(*) AS success, CAST(0 AS BIGINT) AS failed, {counts} FROM documents"
    o["centroids"] = sql("SELECT label, pos, round(x, 6) AS value FROM seeds", "seeds")
    o["nearest_centroid"] = sql("SELECT vec_id, best, round(score, 6) AS score, round(margin, 6) AS margin FROM best", "best")
    o["cosine_pairs"] = sql(
        "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), vec), 6) AS similarity FROM embeddings JOIN centroids USING (label)", "centroids"
    )
    o["centroid_fallback"] = sql(
        """SELECT vec_id, best AS sub, 'Embedding' AS source, round_even(score, 3) AS score, round_even(margin, 3) AS margin FROM best
        WHERE score >= 0.2 AND margin >= 0.03 AND NOT (vec_id % 5 = 0 AND best = '3')""",
        "best",
    )
    o["rules_then_centroids"] = sql(
        f"""SELECT doc_id AS Review_ID, sub AS Sub_Scene FROM ({tags('scene')})
        UNION ALL SELECT vec_id, best FROM best JOIN documents ON doc_id = vec_id WHERE score >= 0.5 AND margin >= 0.03 AND trim(text) <> ''
        AND vec_id NOT IN (SELECT doc_id FROM ({tags('scene')}))""",
        "best",
    )

    ruled = f"hit AS (SELECT doc_id, count(*) AS n FROM ({tags('scene')}) GROUP BY doc_id)"
    bad = "(vec_id % 7 = 0 AND n IS NULL AND trim(text) <> '')"
    o["tag_failures"] = sql(
        f"""SELECT d.doc_id AS Review_ID, CASE WHEN {bad} THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        CASE WHEN {bad} THEN (SELECT concat('vector must have ', CAST(max(len(embedding)) AS VARCHAR), ' elements') FROM embeddings) END AS error,
        CAST(CASE WHEN {bad} THEN 0 ELSE coalesce(n, CASE WHEN trim(text) <> '' AND score >= 0.5 AND margin >= 0.03 THEN 1 ELSE 0 END) END AS INT) AS scenes
        FROM documents d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN best ON vec_id = d.doc_id""",
        "best", extra=ruled,
    )
    o["fallback_exclusion"] = sql(
        f"""SELECT doc_id AS Review_ID, sub AS Motivation_Sub, 'Regex' AS Motivation_Source FROM ({tags('motivation')})
        UNION ALL SELECT vec_id, sub, 'Embedding' FROM allowed JOIN documents ON doc_id = vec_id WHERE score >= 0.55 AND margin >= 0.03 AND trim(text) <> ''
        AND vec_id NOT IN (SELECT doc_id FROM ({tags('motivation')}))""",
        "scored",
        extra="allowed AS (SELECT vec_id, arg_max(label, sim) AS sub, max(sim) AS score, max(sim) - (max(sim, 2))[2] AS margin FROM scored WHERE label <> '3' GROUP BY vec_id)",
    )
    bit = "(strpos('0123456789abcdef', substr(md5(concat(CAST(pos // 128 AS VARCHAR), ':', w)), CAST(pos % 128 // 4 AS INT) + 1, 1)) - 1) >> CAST(3 - pos % 4 AS INT) & 1"
    o["text_vectors"] = sql(
        f"""SELECT doc_id, CAST(pos AS INT) AS pos, round(CAST(CAST(sum(weight * (2 * bit - 1)) / sqrt(384) AS FLOAT) AS DOUBLE), 3) AS value
        FROM (SELECT doc_id, w, n * ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + texts)) AS weight FROM counted JOIN frequency USING (w))
        JOIN (SELECT w, pos, {bit} AS bit FROM frequency, range(384) AS r(pos)) USING (w) GROUP BY doc_id, pos""",
        extra=words("doc_id", "text", "documents", "false")
        + ", counted AS (SELECT doc_id, w, count(*) AS n FROM words GROUP BY doc_id, w), frequency AS (SELECT w, count(*) AS texts FROM counted GROUP BY w)",
    )

    # incremental and dimensions
    o["unprocessed_anti"] = sql("SELECT Review_ID, Clean_Text, Rating FROM todo", "todo")
    o["upsert_status"] = sql(
        "SELECT Review_ID, Model_Version, Processing_Status FROM status WHERE Review_ID NOT IN (SELECT Review_ID FROM delta) UNION ALL SELECT Review_ID, Model_Version, Processing_Status FROM delta",
        "delta",
    )
    o["replace_bridge"] = sql(
        """SELECT doc_id AS Review_ID, concat('old', CAST(quality AS VARCHAR)) AS Tag FROM labels WHERE doc_id NOT IN (SELECT Review_ID FROM delta)
        UNION ALL SELECT Review_ID, 'new' FROM delta WHERE Processing_Status = 'SUCCESS'""",
        "delta",
    )
    o["retag_some"] = """SELECT CAST(doc_id AS VARCHAR) AS Review_ID, source AS Main_Scene, 'old' AS Sub_Scene FROM documents WHERE n_chars % 97 <> 0
        UNION ALL SELECT CAST(doc_id AS VARCHAR), lang, 'new' FROM documents WHERE n_chars % 97 = 0 AND n_chars % 2 = 0"""
    o["keyword_upsert"] = sql(
        """SELECT CAST(doc_id AS VARCHAR) AS Review_ID, concat_ws(';', lang, source) AS Keywords FROM documents WHERE doc_id NOT IN (SELECT Review_ID FROM delta)
        UNION ALL SELECT CAST(Review_ID AS VARCHAR), CASE WHEN Processing_Status = 'SUCCESS' THEN concat('new;', Model_Version) ELSE '' END FROM delta""",
        "delta",
    )
    pick = ", ".join(
        f"min(struct_pack(k := Review_Key, v := {c})) FILTER ({c} IS NOT NULL).v AS {n}"
        for c, n in (("Clean_Text", "Clean_Text"), ("Rating", "Rating"), ("Helpful_Votes", "Helpful"), ("Review_Date", "Review_Date"))
    )
    o["dim_review"] = sql(
        f"""SELECT r.*, k.Keywords FROM (SELECT Review_ID, {pick} FROM raw GROUP BY Review_ID) r LEFT JOIN (
        SELECT doc_id AS Review_ID, concat('k', CAST(quality AS VARCHAR)) AS Keywords FROM labels) k USING (Review_ID)""",
        "raw",
    )
    o["dim_asinreview"] = sql("SELECT DISTINCT ASIN, Review_ID, Review_Key FROM raw", "raw")
    o["product_dim"] = sql(
        """SELECT p.asin, concat('A', brand) AS brand, price, price_band, m.model FROM (SELECT asin, brand, price, price_band FROM product) p LEFT JOIN (
        SELECT p_partkey AS asin, p_type AS model FROM part UNION ALL SELECT p_partkey, 'SECOND' FROM part WHERE p_partkey % 50 = 0) m USING (asin)
        WHERE p.asin IN (SELECT l_partkey FROM lineitem)""",
        "product",
    )
    o["blank_scope_tests"] = """SELECT c_mktsegment, n_name, scope, customers, one AS has_one_nation,
        CASE WHEN negative IS NOT NULL THEN round(CAST(negative AS DOUBLE) / customers, 6) END AS negative_rate FROM (
        SELECT c_mktsegment, n_name, CAST(grouping(c_mktsegment) * 2 + grouping(n_name) AS BIGINT) AS scope, count(*) AS customers,
        sum(CASE WHEN c_acctbal < 0 THEN 1 END) AS negative, count(DISTINCT c_nationkey) = 1 AS one
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (c_mktsegment, n_name))"""
    o["safe_ratios"] = """SELECT doc_id, round_even(CAST(n_chars AS DOUBLE) / nullif(n_chars % 3, 0), 6) AS ratio, round_even(n_chars / CAST(16 AS DOUBLE), 3) AS signal,
        CAST(length(CASE WHEN trim(coalesce(text, '')) = '' THEN ' ' ELSE text END) AS INT) AS encoder_length FROM documents"""

    # sources and sinks
    full, optional = "doc_id % 10 < 5", "doc_id % 10 < 9"
    o["landing_roundtrip"] = f"""SELECT concat('R', CAST(doc_id AS VARCHAR)) AS Review_ID, 'part' AS ASIN, n_chars % 7 AS Rating, {clean("concat(source, ' ', text)")} AS Clean_Text,
        CASE WHEN {full} AND doc_id % 5 <> 0 THEN DATE '2024-03-01' END AS Review_Date, CASE WHEN {full} THEN n_chars % 11 ELSE 0 END AS Helpful_Votes,
        CASE WHEN {full} THEN 'Yes' END AS Verified, CAST(NULL AS VARCHAR) AS Variant FROM documents WHERE {optional}"""
    o["landing_provenance"] = f"SELECT CASE WHEN {full} THEN 'full' ELSE 'short' END AS place, count(*) AS rows, true AS one_stamp FROM documents WHERE {optional} GROUP BY 1"
    o["landing_rejects"] = "SELECT DISTINCT 'URL' AS missing FROM documents WHERE doc_id % 10 = 9"
    names = ("review_features", "scene_bridge", "friction_bridge", "motivation_bridge", "time_bridge", "location_bridge")
    o["feature_tables"] = 'SELECT \'review_processing\' AS "table", count(*) AS rows FROM labels UNION ALL ' + " UNION ALL ".join(
        f"SELECT '{n}', CAST(0 AS BIGINT)" for n in names
    )
    merged = " UNION ALL ".join(
        f"SELECT Review_ID, '{sub}' AS sub FROM one WHERE trim(Clean_Text) <> '' AND {found(pattern, 'Clean_Text')}" for _, sub, pattern, _ in label_patterns(small.RULES, "scene")
    )
    o["tag_status"] = sql(
        f"""SELECT CAST(o.Review_ID AS VARCHAR) AS Review_ID, 'v2' AS Model_Version, 'SUCCESS' AS Processing_Status, coalesce(n, 0) AS scenes
        FROM one o LEFT JOIN (SELECT Review_ID, count(*) AS n FROM ({merged}) GROUP BY Review_ID) t ON o.Review_ID = t.Review_ID""",
        "raw", extra="one AS (SELECT Review_ID, min(struct_pack(k := Review_Key, v := Clean_Text)).v AS Clean_Text FROM raw WHERE Clean_Text IS NOT NULL GROUP BY Review_ID)",
    )
    o["stream_ingest_tag"] = """SELECT concat('R', CAST(doc_id AS VARCHAR)) AS Review_ID, 'v1' AS Model_Version, 'SUCCESS' AS Processing_Status
        FROM documents WHERE doc_id % 10 < 9"""
    return o
