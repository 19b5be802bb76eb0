"""The catalog's results as DuckDB SQL, for checking."""

from __future__ import annotations

UNIT = "CAST(round_even({0} * 10000, 0) AS BIGINT)"


def money_sum(x: str) -> str:
    return f"CAST(coalesce(SUM({UNIT.format(x)}), 0) AS DOUBLE) / 10000"


def money_mean(x: str) -> str:
    return f"CAST(SUM({UNIT.format(x)}) AS DOUBLE) / 10000 / COUNT({x})"


def even(x: str, digits: int) -> str:
    return f"round_even(({x}) * 1e{digits}, 0) / 1e{digits}"


def floor_days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000) AS INTEGER)"


RFM_SELECT = """
    SELECT CustomerID, {recency} AS Recency, Frequency, Monetary, FirstPurchase, LastPurchase
    FROM (SELECT CustomerID, max(InvoiceDate) AS LastPurchase, min(InvoiceDate) AS FirstPurchase,
                 count(DISTINCT InvoiceNo) AS Frequency, greatest({money}, 0.0) AS Monetary
          FROM {source} WHERE CustomerID IS NOT NULL GROUP BY CustomerID)
"""
SNAPSHOT = "TIMESTAMP '2001-09-01 11:30:00'"


def rfm_of(source: str, snapshot: str | None = None) -> str:
    moment = snapshot or f"(SELECT max(InvoiceDate) + INTERVAL 1 DAY FROM {source})"
    return RFM_SELECT.format(
        recency=floor_days(moment, "LastPurchase"), money=money_sum("TotalPrice"), source=source
    )


def behaviour_of(source: str) -> str:
    return f"""
    SELECT b.CustomerID, avg_basket_size, unique_products, avg_days_between,
           CASE WHEN m.Country = 'NATION_9' THEN 1 ELSE 0 END AS is_uk
    FROM (SELECT CustomerID, {money_mean('TotalPrice')} AS avg_basket_size,
                 count(DISTINCT StockCode) AS unique_products
          FROM {source} GROUP BY CustomerID) b
    JOIN (SELECT CustomerID, avg(gap) AS avg_days_between
          FROM (SELECT CustomerID, date_diff('day', lag(d) OVER (PARTITION BY CustomerID ORDER BY d), d) AS gap
                FROM (SELECT DISTINCT CustomerID, CAST(InvoiceDate AS DATE) AS d FROM {source}))
          GROUP BY CustomerID) g ON g.CustomerID = b.CustomerID
    JOIN (SELECT CustomerID, Country
          FROM (SELECT CustomerID, Country,
                       row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS r
                FROM {source} GROUP BY CustomerID, Country) WHERE r = 1) m ON m.CustomerID = b.CustomerID
    """


def daily_of(source: str, key: str = "") -> str:
    """Gap-free daily totals, by way of a calendar join."""
    part = f"{key}," if key else ""
    on = f"AND a.{key} = s.{key}" if key else ""
    group = f"GROUP BY {key}" if key else ""
    return f"""
    SELECT {'s.' + key + ',' if key else ''} s.d AS InvoiceDate, coalesce(Revenue, 0) AS Revenue,
           coalesce(Orders, 0) AS Orders, CAST(coalesce(ItemsSold, 0) AS BIGINT) AS ItemsSold,
           coalesce(Customers, 0) AS Customers
    FROM (SELECT {part} CAST(unnest(generate_series(min(CAST(InvoiceDate AS DATE)),
                 max(CAST(InvoiceDate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d FROM {source} {group}) s
    LEFT JOIN (SELECT {part} CAST(InvoiceDate AS DATE) AS d, {money_sum('TotalPrice')} AS Revenue,
                      count(DISTINCT InvoiceNo) AS Orders, SUM(Quantity) AS ItemsSold,
                      count(DISTINCT CustomerID) AS Customers
               FROM {source} GROUP BY {part} CAST(InvoiceDate AS DATE)) a ON a.d = s.d {on}
    """


CTES = f"""
WITH RECURSIVE tx AS (
    SELECT
      CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
           ELSE CAST(l.l_orderkey AS VARCHAR) END AS InvoiceNo,
      CAST(l.l_partkey AS VARCHAR) AS StockCode,
      p.p_name AS Description,
      CAST(CASE WHEN l.l_returnflag = 'R' AND l.l_linenumber = 1 THEN -l.l_quantity
                WHEN l.l_linenumber = 2 AND l.l_partkey % 50 = 0 THEN 0
                ELSE l.l_quantity END AS INTEGER) AS Quantity,
      o.o_orderdate + INTERVAL '1' HOUR * (8 + l.l_linenumber) AS InvoiceDate,
      CASE WHEN l.l_linenumber = 3 AND l.l_partkey % 50 = 0 THEN CAST(0 AS DOUBLE)
           ELSE FLOOR(l.l_extendedprice / l.l_quantity * 100) / CAST(100 AS DOUBLE) END AS UnitPrice,
      CASE WHEN o.o_orderkey % 50 = 0 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END AS CustomerID,
      n.n_name AS Country
    FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
labelled AS (
    SELECT *, CASE WHEN upper(InvoiceNo) LIKE 'C%' THEN 'cancelled'
                   WHEN CustomerID IS NULL THEN 'null_customer'
                   WHEN Quantity <= 0 THEN 'nonpositive_quantity'
                   WHEN UnitPrice <= 0 THEN 'nonpositive_price'
                   WHEN InvoiceDate IS NULL THEN 'bad_date' END AS drop_reason
    FROM tx),
cleaned AS (
    SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice,
           CAST(CustomerID AS BIGINT) AS CustomerID, Country, Quantity * UnitPrice AS TotalPrice
    FROM labelled WHERE drop_reason IS NULL),
text_dates AS (
    SELECT InvoiceNo, StockCode, Quantity, InvoiceDate FROM tx WHERE CAST(StockCode AS INTEGER) % 7 <> 0),
text_dates_read AS (
    SELECT InvoiceNo, StockCode, Quantity,
           CASE WHEN CAST(StockCode AS INTEGER) % 7 = 1 THEN date_trunc('minute', InvoiceDate)
                ELSE InvoiceDate END AS InvoiceDate
    FROM text_dates),
rfm AS ({rfm_of('cleaned')}),
behaviour AS ({behaviour_of('cleaned')}),
early AS (SELECT * FROM cleaned WHERE InvoiceDate < TIMESTAMP '1997-01-01 00:00:00'),
early_behaviour AS ({behaviour_of('early')}),
rfm_early AS (
    SELECT r.*, e.avg_basket_size, e.unique_products, e.avg_days_between, e.is_uk
    FROM rfm r LEFT JOIN early_behaviour e ON e.CustomerID = r.CustomerID),
churn AS (
    SELECT r.*, b.avg_basket_size, b.unique_products,
           coalesce(b.avg_days_between, CAST(r.Recency AS DOUBLE)) AS avg_days_between, b.is_uk,
           CASE WHEN r.Recency > 90 THEN 1 ELSE 0 END AS churned
    FROM rfm r JOIN behaviour b ON b.CustomerID = r.CustomerID),
daily AS ({daily_of('cleaned')}),
daily_country AS ({daily_of('cleaned', 'Country')}),
sku AS (
    SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS UnitsSold,
           {money_sum('(Quantity * UnitPrice)')} AS Revenue, {money_mean('UnitPrice')} AS AvgUnitPrice,
           max(InvoiceDate) AS LastSale
    FROM cleaned WHERE StockCode IS NOT NULL AND Description IS NOT NULL GROUP BY StockCode, Description),
span AS (
    SELECT greatest(({floor_days('max(InvoiceDate)', 'min(InvoiceDate)')} + 1) / CAST(365.25 AS DOUBLE),
                    CAST(0.01 AS DOUBLE)) AS span_years,
           max(InvoiceDate) + INTERVAL 1 DAY AS reference FROM cleaned),
sku_run AS (
    SELECT *, SUM({UNIT.format('Revenue')}) OVER w AS run, SUM({UNIT.format('Revenue')}) OVER () AS total,
           row_number() OVER w AS sku_rank
    FROM sku WINDOW w AS (ORDER BY Revenue DESC, StockCode, Description)),
abc AS (
    SELECT *, CASE WHEN total <= 0 THEN 'C' WHEN sku_rank = 1 THEN 'A'
                   WHEN CAST(run AS DOUBLE) <= CAST(0.80 AS DOUBLE) * CAST(total AS DOUBLE) THEN 'A'
                   WHEN CAST(run AS DOUBLE) <= CAST(0.95 AS DOUBLE) * CAST(total AS DOUBLE) THEN 'B'
                   ELSE 'C' END AS ABC
    FROM sku_run),
abc_demand AS (
    SELECT a.*, {even('CAST(UnitsSold AS DOUBLE) / span_years', 1)} AS AnnualDemand,
           {floor_days('reference', 'LastSale')} AS DaysSinceLastSale
    FROM abc a, span),
inventory AS (
    SELECT StockCode, Description, UnitsSold, Revenue, AvgUnitPrice, LastSale, ABC, AnnualDemand,
           {even('CASE WHEN AnnualDemand > 0 AND AvgUnitPrice > 0 THEN sqrt(2.0::DOUBLE * AnnualDemand * 50.0::DOUBLE / (0.25::DOUBLE * AvgUnitPrice)) ELSE 0.0 END', 1)} AS EOQ,
           DaysSinceLastSale, CASE WHEN DaysSinceLastSale > 60 THEN 1 ELSE 0 END AS IsDeadStock,
           CAST(50.0 AS DOUBLE) AS OrderingCost, CAST(0.25 AS DOUBLE) AS HoldingPct
    FROM abc_demand),
split AS (
    SELECT *, CASE WHEN row_number() OVER (ORDER BY InvoiceDate, InvoiceNo, StockCode, Description, Quantity,
                                           UnitPrice, CustomerID, Country, TotalPrice)
                        <= floor((SELECT count(*) FROM cleaned) * CAST(0.7 AS DOUBLE))
                   THEN 'reference' ELSE 'current' END AS side
    FROM cleaned),
drift_cells AS (
    SELECT side, 'Quantity' AS "column", CAST(Quantity AS DOUBLE) AS v, NULL AS t FROM split
    UNION ALL SELECT side, 'UnitPrice', UnitPrice, NULL FROM split
    UNION ALL SELECT side, 'TotalPrice', TotalPrice, NULL FROM split
    UNION ALL SELECT side, 'Hour', CAST(hour(InvoiceDate) AS DOUBLE), NULL FROM split
    UNION ALL SELECT side, 'Country', NULL, Country FROM split
    UNION ALL SELECT side, 'DayOfWeek', NULL, CAST(isodow(InvoiceDate) - 1 AS VARCHAR) FROM split),
"""

# Scores from drift cells named {cells}.
DRIFT = """
{out}_counts AS (
    SELECT "column", v, t, count(*) FILTER (WHERE side = 'reference') AS nr,
           count(*) FILTER (WHERE side = 'current') AS nc
    FROM {cells} WHERE v IS NOT NULL OR t IS NOT NULL GROUP BY "column", v, t),
{out}_norm AS (
    SELECT *, nr / CAST(SUM(nr) OVER (PARTITION BY "column") AS DOUBLE) AS p,
           nc / CAST(SUM(nc) OVER (PARTITION BY "column") AS DOUBLE) AS q
    FROM {out}_counts),
{out}_run AS (
    SELECT *, SUM(p) OVER w - SUM(q) OVER w AS gap, lead(v) OVER w AS nxt
    FROM {out}_norm WINDOW w AS (PARTITION BY "column" ORDER BY v, t)),
{out}_spread AS (
    SELECT "column", greatest(stddev_pop(v), 0.001) AS spread FROM {cells} WHERE side = 'reference' GROUP BY "column"),
{out} AS (
    SELECT r."column",
           CASE WHEN count(v) > 0 THEN 'Wasserstein distance (normed)' ELSE 'Jensen-Shannon distance' END AS method,
           CASE WHEN count(v) > 0 THEN coalesce(SUM(abs(gap) * (nxt - v)), 0) / max(spread)
                ELSE sqrt(greatest(0.5 * SUM(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                                 + 0.5 * SUM(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END), 0)) END AS score,
           CAST(0.1 AS DOUBLE) AS threshold
    FROM {out}_run r LEFT JOIN {out}_spread s ON s."column" = r."column" GROUP BY r."column")
"""

CTES += DRIFT.format(out="drift", cells="drift_cells") + f""",
event_split AS (
    SELECT *, CASE WHEN row_number() OVER (ORDER BY ts, event_id, event_type, value)
                        <= floor((SELECT count(*) FROM events) * CAST(0.6 AS DOUBLE))
                   THEN 'reference' ELSE 'current' END AS side
    FROM events),
event_cells AS (
    SELECT side, 'value' AS "column", value AS v, NULL AS t FROM event_split
    UNION ALL SELECT side, 'hour', CAST(hour(ts) AS DOUBLE), NULL FROM event_split
    UNION ALL SELECT side, 'event_type', NULL, event_type FROM event_split
    UNION ALL SELECT side, 'weekday', NULL, CAST(isodow(ts) - 1 AS VARCHAR) FROM event_split),
""" + DRIFT.format(out="event_drift", cells="event_cells") + f""",
clustered AS (SELECT *, CAST(CustomerID % 5 AS INTEGER) AS cluster FROM rfm),
centroids AS (
    SELECT cluster, CAST(SUM(Recency) AS DOUBLE) / count(*) AS Recency,
           CAST(SUM(Frequency) AS DOUBLE) / count(*) AS Frequency, {money_mean('Monetary')} AS Monetary
    FROM clustered GROUP BY cluster),
limits AS (
    SELECT quantile_cont(Monetary, 0.75) AS m75, quantile_cont(Frequency, 0.75) AS f75,
           quantile_cont(Frequency, 0.5) AS f50, quantile_cont(Recency, 0.25) AS r25,
           quantile_cont(Recency, 0.75) AS r75 FROM centroids),
wishes AS (
    SELECT cluster, row_number() OVER (ORDER BY cluster) AS n,
           CASE WHEN Monetary >= m75 AND Frequency >= f75 AND Recency <= r25 THEN 'Champions'
                WHEN Monetary >= m75 AND Frequency >= f75 THEN 'Loyal Customers'
                WHEN Monetary >= m75 AND Recency >= r75 THEN 'At Risk'
                WHEN Frequency < f50 AND Recency >= r75 THEN 'Hibernating'
                ELSE 'Regular' END AS wish
    FROM centroids, limits),
given(n, cluster, persona, used) AS (
    SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST([] AS VARCHAR[])
    UNION ALL
    SELECT w.n, w.cluster, pick.p, list_append(g.used, pick.p)
    FROM given g JOIN wishes w ON w.n = g.n + 1,
    LATERAL (SELECT CASE WHEN list_contains(g.used, w.wish) THEN coalesce(
                list_filter(['Champions', 'Loyal Customers', 'Regular', 'At Risk', 'Hibernating'],
                            lambda x: NOT list_contains(g.used, x))[1], w.wish) ELSE w.wish END AS p) pick),
personas AS (SELECT cluster, persona FROM given WHERE n > 0),
named AS (SELECT c.*, p.persona FROM clustered c JOIN personas p ON p.cluster = c.cluster),
ranks(persona, persona_rank) AS (
    VALUES ('Champions', 0), ('Loyal Customers', 1), ('Regular', 2), ('At Risk', 3), ('Hibernating', 4)),
scored AS (
    SELECT CustomerID, CASE WHEN Recency > 90 THEN 1 ELSE 0 END AS churned,
           CAST((CustomerID * 37 + 11) % 101 AS DOUBLE) / 100.0::DOUBLE AS churn_probability
    FROM rfm),
naive AS (
    SELECT * FROM (SELECT 'ALL' AS series_key, InvoiceDate AS ds, Revenue AS y,
                          lag(Revenue, 7) OVER (ORDER BY InvoiceDate) AS yhat,
                          max(InvoiceDate) OVER () AS newest FROM daily)
    WHERE ds > newest - INTERVAL 30 DAY)
"""

ROLLING = ", ".join(
    f"""{even(f"CASE WHEN count(Revenue) OVER w{w} >= {w // 2} THEN avg(Revenue) OVER w{w} END", 3)} AS rolling_mean_{w},
        {even(f"CASE WHEN count(Revenue) OVER w{w} >= {w // 2} THEN stddev_samp(Revenue) OVER w{w} END", 3)} AS rolling_std_{w}"""
    for w in (7, 14, 30)
)
ROLLING_WINDOWS = "WINDOW o AS (ORDER BY InvoiceDate), " + ", ".join(
    f"w{w} AS (ORDER BY InvoiceDate ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)" for w in (7, 14, 30)
)
LAGS = ", ".join(f"lag(Revenue, {n}) OVER o AS lag_{n}" for n in (1, 7, 14))
CALENDAR = """
    CAST(isodow(InvoiceDate) - 1 AS TINYINT) AS day_of_week,
    CAST(CASE WHEN isodow(InvoiceDate) >= 6 THEN 1 ELSE 0 END AS TINYINT) AS is_weekend,
    CAST(day(InvoiceDate) AS TINYINT) AS day_of_month, CAST(month(InvoiceDate) AS TINYINT) AS month,
    CAST(weekofyear(InvoiceDate) AS SMALLINT) AS iso_week, CAST(year(InvoiceDate) AS SMALLINT) AS year
"""
FULL_FEATURES = (
    f"SELECT InvoiceDate, Revenue, Orders, ItemsSold, Customers, {CALENDAR}, {LAGS}, {ROLLING} FROM daily {ROLLING_WINDOWS}"
)
RAW_TEXT = (
    "SELECT InvoiceNo, StockCode, Description, Quantity, strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS InvoiceDate, "
    "UnitPrice, CustomerID, Country FROM tx"
)
REPORT_ROW = """
    SELECT count(*) AS rows_in, count(*) FILTER (WHERE drop_reason IS NULL) AS rows_out,
           count(*) FILTER (WHERE drop_reason = 'cancelled') AS cancelled_dropped,
           count(*) FILTER (WHERE drop_reason = 'null_customer') AS null_customer_dropped,
           count(*) FILTER (WHERE drop_reason = 'nonpositive_quantity') AS nonpositive_quantity_dropped,
           count(*) FILTER (WHERE drop_reason = 'nonpositive_price') AS nonpositive_price_dropped,
           count(*) FILTER (WHERE drop_reason = 'bad_date') AS bad_date_dropped
    FROM labelled
"""
INVENTORY_METRICS = f"""
    SELECT CAST(count(*) AS DOUBLE) AS n_skus,
           CAST(count(*) FILTER (WHERE ABC = 'A') AS DOUBLE) AS n_class_a,
           CAST(count(*) FILTER (WHERE ABC = 'B') AS DOUBLE) AS n_class_b,
           CAST(count(*) FILTER (WHERE ABC = 'C') AS DOUBLE) AS n_class_c,
           CAST(SUM(IsDeadStock) AS DOUBLE) AS n_dead_stock,
           CAST(SUM(IsDeadStock) AS DOUBLE) / count(*) AS dead_stock_pct,
           {money_sum('Revenue')} AS total_revenue, (SELECT span_years FROM span) AS span_years
    FROM inventory
"""


def _expectation_rows() -> str:
    source = "(SELECT *, Quantity * UnitPrice AS TotalPrice FROM tx)"
    rows = [
        "SELECT 'row_count' AS expectation, '' AS \"column\", count(*) AS evaluated, "
        f"CAST(CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END AS BIGINT) AS unexpected FROM {source}"
    ]
    for c in ("CustomerID", "InvoiceNo", "InvoiceDate", "StockCode", "Quantity", "UnitPrice"):
        rows.append(
            f"SELECT 'not_null', '{c}', count(*), count(*) FILTER (WHERE {c} IS NULL) FROM {source}"
        )
    for c, low in (("Quantity", 1), ("UnitPrice", 0.01), ("TotalPrice", 0.01)):
        rows.append(
            f"SELECT 'between', '{c}', count({c}), count(*) FILTER (WHERE {c} < CAST({low} AS DOUBLE)) FROM {source}"
        )
    return "SELECT *, unexpected = 0 AS success FROM (" + " UNION ALL ".join(rows) + ")"


def _describe_rows() -> str:
    rows = [
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {even(f'avg({c})', 4)} AS mean, "
        f"{even(f'stddev_samp({c})', 4)} AS std, CAST(min({c}) AS DOUBLE) AS min, "
        + ", ".join(
            f"{even(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} AS {name}"
            for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
        )
        + f", CAST(max({c}) AS DOUBLE) AS max FROM rfm"
        for c in ("Recency", "Frequency", "Monetary")
    ]
    return " UNION ALL ".join(rows)


def _quantile_rows() -> str:
    rows = [
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p, "
        f"{even(f'quantile_cont(CAST({c} AS DOUBLE), {p})', 4)} AS value FROM cleaned"
        for c in ("UnitPrice", "Quantity", "TotalPrice")
        for p in (0.01, 0.5, 0.9, 0.99)
    ]
    return " UNION ALL ".join(rows)


def _ladder(column: str, edges: list, names: list[str]) -> str:
    arms = " ".join(f"WHEN {column} <= {e} THEN '{n}'" for e, n in zip(edges[1:], names))
    return f"CASE WHEN {column} <= {edges[0]} THEN NULL {arms} END"


def _crosstab() -> str:
    m_names = ["<300", "300-800", "800-1500", "1500-3000", "3000+"]
    cells = ", ".join(f"count(*) FILTER (WHERE m = '{n}') AS \"{n}\"" for n in m_names)
    r = _ladder("Recency", [-1, 10, 30, 60, 120, "'infinity'::DOUBLE"], ["<10", "10-30", "30-60", "60-120", "120+"])
    f = _ladder("Frequency", [0, 2, 5, 10, 20, "'infinity'::DOUBLE"], ["1-2", "3-5", "6-10", "11-20", "20+"])
    m = _ladder("Monetary", [0, 300, 800, 1500, 3000, "'infinity'::DOUBLE"], m_names)
    inside = "r IS NOT NULL AND f IS NOT NULL AND m IS NOT NULL"
    return f"""
    SELECT coalesce(r, 'All') AS recency_bucket, coalesce(f, 'All') AS frequency_bucket, {cells}, count(*) AS "All"
    FROM (SELECT CASE WHEN {inside} THEN r ELSE 'outside' END AS r, CASE WHEN {inside} THEN f ELSE 'outside' END AS f, CASE WHEN {inside} THEN m END AS m
          FROM (SELECT {r} AS r, {f} AS f, {m} AS m FROM rfm))
    GROUP BY GROUPING SETS ((r, f), ())
    """


SCORED_COUNTS = """
    SELECT count(*) FILTER (WHERE churned = 1 AND churn_probability >= 0.5) AS tp,
           count(*) FILTER (WHERE churned = 0 AND churn_probability >= 0.5) AS fp,
           count(*) FILTER (WHERE churned = 1 AND churn_probability < 0.5) AS fn,
           count(*) AS n FROM scored
"""
# Both tests from the counts that the distances use; the chi-square tail by the series of the lower part.
P_VALUES = """,
    statistics AS (
        SELECT "column", count(v) > 0 AS is_number, max(abs(gap)) AS d, sum(nr) AS n, sum(nc) AS m, count(*) - 1 AS freedom,
               sum(pow(nc - CAST(nr AS DOUBLE) * total_c / total_r, 2) / (CAST(nr AS DOUBLE) * total_c / total_r)) / 2 AS h
        FROM (SELECT *, sum(nr) OVER (PARTITION BY "column") AS total_r, sum(nc) OVER (PARTITION BY "column") AS total_c FROM drift_run)
        GROUP BY "column"),
    tested AS (
        SELECT "column", CASE WHEN is_number THEN 'K-S p_value' ELSE 'chi-square p_value' END AS method,
               CASE WHEN is_number
                    THEN greatest(least(2 * list_sum(list_transform(range(1, 400), lambda j: (CASE WHEN j % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * j * j * d * d * n * m / (n + m)))), 1.0), 0.0)
                    ELSE 1 - list_sum(list_transform(range(0, 2000), lambda i: exp((freedom / 2 + i) * ln(greatest(h, 1e-300)) - h - lgamma(freedom / 2 + i + 1)))) END AS score
        FROM statistics)"""
DAY_CELLS = """day_split AS (SELECT *, CASE WHEN InvoiceDate < TIMESTAMP '2000-01-01' THEN 'reference' ELSE 'current' END AS side FROM cleaned),
    day_cells AS (
        SELECT side, 'Quantity' AS "column", CAST(Quantity AS DOUBLE) AS v, CAST(NULL AS VARCHAR) AS t FROM day_split
        UNION ALL SELECT side, 'UnitPrice', UnitPrice, NULL FROM day_split
        UNION ALL SELECT side, 'TotalPrice', TotalPrice, NULL FROM day_split
        UNION ALL SELECT side, 'Hour', CAST(hour(InvoiceDate) AS DOUBLE), NULL FROM day_split)"""
FEATURES = (
    "(VALUES ('Recency'), ('Frequency'), ('Monetary'), ('avg_basket_size'), ('unique_products'), "
    "('avg_days_between'), ('is_uk')) f(feature)"
)
MODEL_ROWS = """
    SELECT model, n - t AS n_train, t AS n_test, round_even(churners / n * 1e9, 0) / 1e9 AS churn_rate, true AS in_range, true AS beats_chance
    FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(ceil(count(*) * 0.2) AS DOUBLE) AS t, CAST(sum(churned) AS DOUBLE) AS churners FROM churn),
         (VALUES {models}) m(model)"""
# Easter by another rule than the library's: the Sunday after the full moon that follows from the year's epact.
EASTER = """
    SELECT y, full_moon + CAST(7 - isodow(full_moon) % 7 AS INTEGER) AS easter
    FROM (SELECT y, make_date(y, 4, 19) - CAST(e AS INTEGER) AS full_moon
          FROM (SELECT y, CASE WHEN epact = 0 OR (epact = 1 AND y % 19 > 10) THEN epact + 1 ELSE epact END AS e
                FROM (SELECT y, (14 + 11 * (y % 19) - (3 * c) // 4 + (5 + 8 * c) // 25 + 3000) % 30 AS epact
                      FROM (SELECT y, y // 100 + 1 AS c FROM years))))"""
HOLIDAYS = f"""
    , years AS (SELECT CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS y FROM (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders)),
    easters AS ({EASTER})
    SELECT c AS country, make_date(y, 1, 1) AS ds, 'NewYearsDay' AS holiday FROM years, (VALUES ('UK'), ('US'), ('DE')) v(c)
    UNION ALL SELECT c, make_date(y, 12, 25), 'ChristmasDay' FROM years, (VALUES ('UK'), ('US'), ('DE')) v(c)
    UNION ALL SELECT 'UK', CASE WHEN isodow(make_date(y, 12, 26)) = 7 THEN make_date(y, 12, 27) ELSE make_date(y, 12, 26) END, 'BoxingDay' FROM years
    UNION ALL SELECT 'UK', easter - 2, 'GoodFriday' FROM easters
    UNION ALL SELECT 'UK', easter + 1, 'EasterMonday' FROM easters
    UNION ALL SELECT 'US', make_date(y, 7, 4), 'IndependenceDay' FROM years
    UNION ALL SELECT 'US', d, 'Thanksgiving' FROM (SELECT make_date(y, 11, CAST(unnest(range(22, 29)) AS INTEGER)) AS d FROM years) WHERE isodow(d) = 4
    UNION ALL SELECT 'DE', make_date(y, 5, 1), 'LabourDay' FROM years
    UNION ALL SELECT 'DE', make_date(y, 10, 3), 'GermanUnity' FROM years"""
SERIES_DAYS = "SELECT Country AS series_key, max(InvoiceDate) AS last_day, count(*) AS n_days, min(InvoiceDate) AS first_day FROM daily_country GROUP BY Country"


def ahead(days: int) -> str:
    return f"SELECT series_key, CAST(unnest(generate_series(last_day + INTERVAL 1 DAY, last_day + INTERVAL {days} DAY, INTERVAL 1 DAY)) AS DATE) AS ds, true AS in_band, true AS no_narrower FROM ({SERIES_DAYS})"


GRID_SETTINGS = (
    "(VALUES ('yearly=false order=10 mode=multiplicative'), ('yearly=true order=10 mode=additive'), "
    "('yearly=true order=5 mode=multiplicative'), ('yearly=false order=0 mode=additive')) g(setting)"
)
JUDGED = "30::BIGINT AS holdout_days, n_days, CAST(NULL AS VARCHAR) AS reason, true AS scored"
SERIES_SUMS = f"""
    SELECT series_key, min(ds) AS first_day, max(ds) AS newest, CAST(max(basis) AS INTEGER) AS basis_days, count(*) AS n_days, max(abs(y)) AS largest,
           {even('sum(y)', 0)} AS total, {even('sum(y * sin(2 * pi() * n / 7))', 0)} AS week_sine, {even('sum(y * t)', 0)} AS with_time,
           {even('sum(y * greatest(t - 0.4::DOUBLE, 0))', 0)} AS with_hinge, {even('sum(y * greatest(t - 0.8::DOUBLE, 0) * cos(2 * pi() * n / 7))', 0)} AS hinge_week_cosine
    FROM (SELECT series_key, ds, y, basis, date_diff('day', DATE '1970-01-01', ds) AS n, CAST(date_diff('day', first_day, ds) AS DOUBLE) / (basis - 1) AS t
          FROM (SELECT Country AS series_key, InvoiceDate AS ds, Revenue AS y, min(InvoiceDate) OVER (PARTITION BY Country) AS first_day,
                       count(*) FILTER (WHERE InvoiceDate <= (SELECT max(InvoiceDate) FROM daily_country) - INTERVAL 100 DAY) OVER (PARTITION BY Country) AS basis
                FROM daily_country))
    GROUP BY series_key"""
TRAINED = f"""
    SELECT 'inventory' AS model, metric, {even('value', 6)} AS value FROM (UNPIVOT ({{inventory}}) ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL SELECT 'churn', metric, CASE metric WHEN 'n_train' THEN n - t WHEN 'n_test' THEN t WHEN 'churn_rate' THEN {even('churners / n', 6)} END
    FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(ceil(count(*) * 0.2) AS DOUBLE) AS t, CAST(sum(churned) AS DOUBLE) AS churners FROM churn),
         (VALUES ('n_train'), ('n_test'), ('churn_rate'), ('auc_roc'), ('accuracy'), ('precision'), ('recall'), ('f1')) m(metric)
    UNION ALL SELECT 'forecasting', metric, CASE metric WHEN 'holdout_days' THEN 30 WHEN 'n_days' THEN (SELECT count(*) FROM daily) END
    FROM (VALUES ('mape'), ('rmse'), ('holdout_days'), ('n_days')) m(metric)
    UNION ALL SELECT 'segmentation', metric, NULL
    FROM (VALUES ('best_k'), ('silhouette'), ('silhouette_error'), ('silhouette_k4'), ('silhouette_k5'), ('silhouette_k6'), ('silhouette_k7'), ('silhouette_k8')) m(metric)"""
AUC = """
    (SELECT CAST(SUM(CASE WHEN a.churn_probability > b.churn_probability THEN 2
                          WHEN a.churn_probability = b.churn_probability THEN 1 ELSE 0 END) AS DOUBLE) / 2 / count(*)
     FROM scored a, scored b WHERE a.churned = 1 AND b.churned = 0)
"""

SPECS: dict[str, str] = {
    "read_transactions_csv": RAW_TEXT,
    "load_raw": RAW_TEXT,
    "read_stage": "SELECT * FROM cleaned",
    "write_stage": "SELECT CAST(year(InvoiceDate) AS INTEGER) AS year, CAST(month(InvoiceDate) AS INTEGER) AS month, count(*) AS rows FROM cleaned GROUP BY 1, 2",
    "write_json_report": REPORT_ROW,
    "read_inventory_csv": "SELECT * FROM inventory",
    "write_inventory_csv": f"SELECT ABC, count(*) AS skus, {money_sum('Revenue')} AS Revenue FROM inventory GROUP BY ABC",
    "table_domain": """
        SELECT Country, CAST(min(InvoiceDate) AS DATE) AS first_date, CAST(max(InvoiceDate) AS DATE) AS last_date,
               (SELECT CAST(min(InvoiceDate) AS DATE) FROM cleaned) AS min_date,
               (SELECT CAST(max(InvoiceDate) AS DATE) FROM cleaned) AS max_date
        FROM cleaned WHERE Country IS NOT NULL GROUP BY Country""",
    "union_sources": "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, InvoiceDate FROM tx",
    "drop_cancelled": "SELECT InvoiceNo, StockCode, Quantity FROM tx WHERE NOT upper(InvoiceNo) LIKE 'C%'",
    "drop_null_customer": "SELECT InvoiceNo, StockCode, CustomerID FROM tx WHERE CustomerID IS NOT NULL",
    "drop_nonpositive_quantity": "SELECT InvoiceNo, StockCode, Quantity FROM tx WHERE NOT Quantity <= 0",
    "drop_nonpositive_price": "SELECT InvoiceNo, StockCode, UnitPrice FROM tx WHERE NOT UnitPrice <= 0",
    "parse_invoice_date": "SELECT * FROM text_dates_read",
    "coerce_dates": "SELECT CAST(InvoiceDate AS DATE) AS day, count(*) AS lines FROM text_dates_read GROUP BY 1",
    "add_total_price": "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, Quantity * UnitPrice AS TotalPrice FROM tx",
    "cast_customer_id": "SELECT InvoiceNo, StockCode, CAST(CustomerID AS BIGINT) AS CustomerID FROM tx WHERE CustomerID IS NOT NULL",
    "clean": "SELECT * FROM cleaned",
    "clean_report": REPORT_ROW,
    "quality_profile": """
        SELECT count(*) AS n_rows,
               CAST(count(*) FILTER (WHERE upper(InvoiceNo) LIKE 'C%') AS DOUBLE) / count(*) AS cancelled_share,
               CAST(count(*) FILTER (WHERE CustomerID IS NULL) AS DOUBLE) / count(*) AS null_customer_share,
               CAST(count(*) FILTER (WHERE Quantity < 0) AS DOUBLE) / count(*) AS negative_quantity_share,
               CAST(count(*) FILTER (WHERE UnitPrice <= 0) AS DOUBLE) / count(*) AS nonpositive_price_share
        FROM tx""",
    "validate_expectations": _expectation_rows(),
    "gate_and_write": f"SELECT CAST(year(InvoiceDate) AS INTEGER) AS year, count(*) AS rows, {money_sum('TotalPrice')} AS revenue FROM cleaned GROUP BY 1",
    "filter_country_dates": """
        SELECT InvoiceNo, StockCode, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, TotalPrice FROM cleaned
        WHERE Country IN ('NATION_9', 'NATION_3') AND InvoiceDate >= TIMESTAMP '1998-03-01'
          AND InvoiceDate < TIMESTAMP '1999-04-01'""",
    "drift_projection": """
        SELECT InvoiceDate, Quantity, UnitPrice, TotalPrice, Country, CAST(hour(InvoiceDate) AS INTEGER) AS Hour,
               CAST(isodow(InvoiceDate) - 1 AS INTEGER) AS DayOfWeek FROM cleaned""",
    "rfm": "SELECT * FROM rfm",
    "rfm_at_snapshot": rfm_of("cleaned", SNAPSHOT),
    "rfm_events": rfm_of(
        "(SELECT CAST(event_id AS VARCHAR) AS InvoiceNo, user_id AS CustomerID, ts AS InvoiceDate, value AS TotalPrice"
        " FROM events WHERE event_type = 'purchase')"
    ),
    "sort_rfm": "SELECT * FROM rfm ORDER BY Monetary DESC, CustomerID",
    "align_by_key": f"SELECT r.*, b.unique_products, {even('b.avg_basket_size', 6)} AS avg_basket_size FROM rfm r JOIN behaviour b ON b.CustomerID = r.CustomerID",
    "rfm_means": f"""
        SELECT count(*) AS n_customers, CAST(SUM(Recency) AS DOUBLE) / count(*) AS mean_recency,
               CAST(SUM(Frequency) AS DOUBLE) / count(*) AS mean_frequency, {money_mean('Monetary')} AS mean_monetary
        FROM rfm""",
    "rfm_crosstab": _crosstab(),
    "distinct_customer_days": "SELECT DISTINCT CustomerID, CAST(InvoiceDate AS DATE) AS day FROM cleaned",
    "days_between_purchases": "SELECT CustomerID, avg_days_between FROM behaviour",
    "customer_behaviour": "SELECT * FROM behaviour",
    "home_country_flag": """
        SELECT CustomerID, Country AS main_country, CASE WHEN Country = 'NATION_9' THEN 1 ELSE 0 END AS is_uk
        FROM (SELECT CustomerID, Country,
                     row_number() OVER (PARTITION BY CustomerID ORDER BY count(*) DESC, Country) AS r
              FROM cleaned GROUP BY CustomerID, Country) WHERE r = 1""",
    "join_rfm_behaviour": """
        SELECT r.*, b.avg_basket_size, b.unique_products, b.avg_days_between, b.is_uk
        FROM rfm r LEFT JOIN behaviour b ON b.CustomerID = r.CustomerID""",
    "join_stored_features": """
        SELECT r.*, b.avg_basket_size, b.unique_products, b.avg_days_between, b.is_uk
        FROM rfm r LEFT JOIN behaviour b ON b.CustomerID = r.CustomerID""",
    "line_rollup": f"""
        SELECT Country, CAST(date_trunc('month', InvoiceDate) AS DATE) AS month, count(*) AS lines, CAST(sum(Quantity) AS BIGINT) AS items,
               {money_sum('TotalPrice')} AS revenue, min(InvoiceDate) AS "first", max(InvoiceDate) AS "last" FROM cleaned GROUP BY 1, 2""",
    "rfm_of_rollup": "SELECT * FROM rfm",
    "behaviour_of_rollup": "SELECT * FROM behaviour",
    "daily_of_rollup": "SELECT * FROM daily_country",
    "sku_sales_of_rollup": "SELECT * FROM sku",
    "merged_states": """
        SELECT r.CustomerID, Recency, Monetary, FirstPurchase, LastPurchase, avg_basket_size, avg_days_between, true AS counts_near
        FROM rfm r JOIN behaviour b ON b.CustomerID = r.CustomerID""",
    "amounts_off_units": """
        SELECT event_type, count(value) AS amounts, count(*) FILTER (WHERE abs(value * 10000 - round_even(value * 10000, 0)) > 1e-3 + 1e-9 * abs(value * 10000)) AS off
        FROM events GROUP BY event_type""",
    "fill_churn_nulls": """
        SELECT CustomerID, Recency, Frequency, Monetary, FirstPurchase, LastPurchase,
               coalesce(avg_basket_size, Monetary / greatest(Frequency, 1)) AS avg_basket_size,
               coalesce(unique_products, 0) AS unique_products,
               coalesce(avg_days_between, CAST(Recency AS DOUBLE)) AS avg_days_between,
               coalesce(is_uk, 0) AS is_uk FROM rfm_early""",
    "fill_model_features": """
        SELECT CustomerID, Recency, Frequency, Monetary, FirstPurchase, LastPurchase,
               coalesce(avg_basket_size, 0) AS avg_basket_size, coalesce(unique_products, 0) AS unique_products,
               coalesce(avg_days_between, 0) AS avg_days_between, coalesce(is_uk, 0) AS is_uk FROM rfm_early""",
    "churn_training_table": "SELECT * FROM churn",
    "churn_training_table_single_pass": "SELECT * FROM churn",
    "churn_label": "SELECT CustomerID, CASE WHEN Recency > 120 THEN 1 ELSE 0 END AS churned FROM rfm",
    "daily_revenue": "SELECT * FROM daily",
    "daily_revenue_by_country": "SELECT * FROM daily_country",
    "calendar_spine": "SELECT * FROM daily_country",
    "daily_resample": "SELECT InvoiceDate, Revenue FROM daily",
    "monthly_revenue": f"SELECT CAST(date_trunc('month', InvoiceDate) AS DATE) AS Month, {money_sum('TotalPrice')} AS Revenue FROM cleaned GROUP BY 1",
    "calendar_features": f"SELECT InvoiceDate, Revenue, {CALENDAR} FROM daily",
    "lag_features": f"SELECT InvoiceDate, Revenue, {LAGS} FROM daily WINDOW o AS (ORDER BY InvoiceDate)",
    "rolling_features": f"SELECT InvoiceDate, Revenue, {ROLLING} FROM daily {ROLLING_WINDOWS}",
    "timeseries_features": FULL_FEATURES,
    "run_features": FULL_FEATURES,
    "rolling_band": f"""
        SELECT InvoiceDate, Revenue, {even('avg(Revenue) OVER w', 3)} AS band_mean,
               {even('avg(Revenue) OVER w - stddev_samp(Revenue) OVER w', 3)} AS band_low,
               {even('avg(Revenue) OVER w + stddev_samp(Revenue) OVER w', 3)} AS band_high
        FROM daily WINDOW w AS (ORDER BY InvoiceDate ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "daily_stability": f"""
        SELECT count(*) AS n_days, {even('stddev_samp(Revenue) / avg(Revenue)', 6)} AS variation,
               {even('corr(Revenue, before)', 6)} AS autocorr_7, count(*) FILTER (WHERE Revenue = 0) AS zero_days
        FROM (SELECT Revenue, lag(Revenue, 7) OVER (ORDER BY InvoiceDate) AS before FROM daily)""",
    "last_value": "SELECT max(InvoiceDate) AS last_date, arg_max(Revenue, InvoiceDate) AS last_actual FROM daily",
    "history_tail": "SELECT * FROM daily WHERE InvoiceDate > (SELECT max(InvoiceDate) FROM daily) - INTERVAL 60 DAY",
    "kpi_summary": f"""
        SELECT *, total_revenue / n_orders AS avg_order_value
        FROM (SELECT {money_sum('TotalPrice')} AS total_revenue, count(DISTINCT InvoiceNo) AS n_orders,
                     count(DISTINCT CustomerID) AS n_customers FROM cleaned)""",
    "revenue_by_country": f"""
        SELECT Country, Revenue,
               {even(f"Revenue / (SELECT {money_sum('TotalPrice')} FROM cleaned) * 100.0::DOUBLE", 2)} AS share_pct
        FROM (SELECT Country, {money_sum('TotalPrice')} AS Revenue FROM cleaned GROUP BY Country)""",
    "share_of_total": f"""
        SELECT Month, Revenue,
               {even(f"Revenue / (SELECT {money_sum('TotalPrice')} FROM cleaned) * 100.0::DOUBLE", 2)} AS share_pct
        FROM (SELECT CAST(date_trunc('month', InvoiceDate) AS DATE) AS Month, {money_sum('TotalPrice')} AS Revenue
              FROM cleaned GROUP BY 1)""",
    "top_products": f"""
        SELECT StockCode, Description, Revenue,
               {even(f"Revenue / ({money_sum('Revenue').replace('), 0)', ') OVER (), 0)')}) * 100.0::DOUBLE", 2)} AS share_pct
        FROM (SELECT StockCode, Description, {money_sum('TotalPrice')} AS Revenue FROM cleaned
              GROUP BY StockCode, Description ORDER BY Revenue DESC, StockCode, Description LIMIT 10)""",
    "country_rows_topn": 'SELECT Country, count(*) AS "count" FROM cleaned GROUP BY Country ORDER BY 2 DESC, 1 LIMIT 10',
    "country_revenue_topn": f"SELECT Country, {money_sum('TotalPrice')} AS Revenue FROM cleaned GROUP BY Country ORDER BY 2 DESC, 1 LIMIT 8",
    "describe": _describe_rows(),
    "exact_quantiles": _quantile_rows(),
    "trimmed_histogram": f"""
        SELECT CAST(bin AS INTEGER) AS bin, {even('a', 4)} AS bin_low, {even('b', 4)} AS bin_high, count(v) AS rows
        FROM (SELECT bin, lo + bin * width AS a, lo + (bin + 1) * width AS b
              FROM (SELECT min(TotalPrice) AS lo, (max(TotalPrice) - min(TotalPrice)) / 40 AS width FROM cleaned
                    WHERE TotalPrice <= (SELECT quantile_cont(TotalPrice, 0.99) FROM cleaned)), (SELECT unnest(range(40)) AS bin))
        LEFT JOIN (SELECT TotalPrice AS v FROM cleaned WHERE TotalPrice <= (SELECT quantile_cont(TotalPrice, 0.99) FROM cleaned))
          ON v >= a AND (v < b OR bin = 39) GROUP BY bin, a, b""",
    "format_currency": """
        SELECT o_orderkey, amount,
               CASE WHEN abs(amount) >= 1e6 THEN printf('$%.2fM', amount / 1e6)
                    WHEN abs(amount) >= 1e3 THEN printf('$%.1fk', amount / 1e3)
                    ELSE printf('$%.0f', round_even(amount, 0)) END AS shown
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN -a ELSE a END AS amount
              FROM (SELECT o_orderkey, floor(o_totalprice * pow(CAST(10.0 AS DOUBLE), o_orderkey % 4 - 2)) AS a FROM orders))""",
    "format_int": """
        SELECT o_orderkey,
               format('{:,}', CAST(trunc(10 * CASE WHEN o_orderkey % 5 = 0 THEN -o_totalprice ELSE o_totalprice END) AS BIGINT)) AS shown
        FROM orders""",
    "floor_days": f"SELECT DISTINCT InvoiceNo, InvoiceDate, {floor_days(SNAPSHOT, 'InvoiceDate')} AS days, {floor_days('InvoiceDate', SNAPSHOT)} AS days_back FROM cleaned",
    "sku_sales": "SELECT * FROM sku",
    "span_years": "SELECT span_years FROM span",
    "cumulative_share": "SELECT StockCode, Description, Revenue, CAST(run AS DOUBLE) / CAST(total AS DOUBLE) AS cum_share, sku_rank FROM sku_run",
    "abc_classify": "SELECT StockCode, Description, ABC FROM abc",
    "eoq": f"""
        SELECT p_partkey, {even('CASE WHEN d > 0 AND p_retailprice > 0 THEN sqrt(2.0::DOUBLE * d * 50.0::DOUBLE / (0.25::DOUBLE * p_retailprice)) ELSE 0.0 END', 6)} AS eoq
        FROM (SELECT p_partkey, p_retailprice, CAST(p_size - 5 AS DOUBLE) * 100 AS d FROM part)""",
    "annual_demand": f"SELECT StockCode, Description, {even('CAST(UnitsSold AS DOUBLE) / CAST(2.5 AS DOUBLE)', 1)} AS AnnualDemand FROM sku",
    "dead_stock_flag": f"SELECT StockCode, Description, CASE WHEN {floor_days(SNAPSHOT, 'LastSale')} > 60 THEN 1 ELSE 0 END AS IsDeadStock FROM sku",
    "eoq_table": "SELECT * FROM inventory",
    "inventory_metrics": INVENTORY_METRICS,
    "log_run": f"SELECT 'inventory' AS model, 'run-1' AS run_id, metric, value FROM (UNPIVOT ({INVENTORY_METRICS}) ON COLUMNS(*) INTO NAME metric VALUE value)",
    "inventory_headline": f"""
        SELECT count(*) AS total_skus, count(*) FILTER (WHERE ABC = 'A') AS n_a, count(*) FILTER (WHERE ABC = 'B') AS n_b,
               count(*) FILTER (WHERE ABC = 'C') AS n_c, count(*) FILTER (WHERE IsDeadStock = 1) AS n_dead,
               CAST(count(*) FILTER (WHERE IsDeadStock = 1) AS DOUBLE) / count(*) * 100.0::DOUBLE AS dead_pct,
               {money_sum('Revenue')} AS total_revenue, {money_sum('EOQ')} AS total_eoq FROM inventory""",
    "abc_distribution": 'SELECT ABC, count(*) AS "count" FROM inventory GROUP BY ABC',
    "abc_order_join": """
        SELECT c.ABC, c.class_rank, n AS "count" FROM (VALUES ('A', 0), ('B', 1), ('C', 2)) c(ABC, class_rank)
        LEFT JOIN (SELECT ABC, count(*) AS n FROM inventory WHERE ABC <> 'B' GROUP BY ABC) i ON i.ABC = c.ABC""",
    "sku_filtered_revenue": f"SELECT StockCode, {money_sum('TotalPrice')} AS CountryRevenue FROM cleaned WHERE Country = 'NATION_9' GROUP BY StockCode",
    "join_filtered_revenue": f"""
        SELECT i.StockCode, i.Description, i.Revenue, coalesce(f.r, 0.0) AS CountryRevenue
        FROM inventory i LEFT JOIN (SELECT StockCode, {money_sum('TotalPrice')} AS r FROM cleaned
                                    WHERE Country = 'NATION_4' GROUP BY StockCode) f ON f.StockCode = i.StockCode""",
    "reorder_list": "SELECT * FROM inventory WHERE ABC = 'B' AND IsDeadStock = 1 ORDER BY Revenue DESC, StockCode, Description LIMIT 25",
    "reorder_table": f"""
        SELECT i.StockCode, i.Description, ABC, UnitsSold, Revenue, coalesce(f.r, 0.0) AS CountryRevenue, AnnualDemand, EOQ,
               DaysSinceLastSale, IsDeadStock
        FROM inventory i LEFT JOIN (SELECT StockCode, {money_sum('TotalPrice')} AS r FROM cleaned
             WHERE Country = 'NATION_9' AND InvoiceDate < TIMESTAMP '2001-07-01' GROUP BY StockCode) f ON f.StockCode = i.StockCode
        WHERE ABC IN ('A', 'C') AND LastSale <= TIMESTAMP '2001-06-30'""",
    "top_reorder_candidates": """
        SELECT StockCode, Description, ABC, UnitsSold, Revenue, EOQ, IsDeadStock FROM inventory
        ORDER BY Revenue DESC, StockCode, Description LIMIT 10""",
    "chronological_split": "SELECT side, InvoiceNo, StockCode, Quantity, InvoiceDate FROM split",
    "drift_scores": f'SELECT "column", method, {even("score", 6)} AS score, threshold, score > threshold AS drift_detected FROM drift',
    "drift_scores_events": f'SELECT "column", method, {even("score", 6)} AS score, threshold, score > threshold AS drift_detected FROM event_drift',
    "drift_summary": """
        SELECT (SELECT count(*) FROM drift) AS n_columns,
               (SELECT count(*) FROM drift WHERE score > threshold) AS n_drifted_columns,
               (SELECT CAST(count(*) FILTER (WHERE score > threshold) AS DOUBLE) / count(*) FROM drift) AS drift_share,
               coalesce((SELECT string_agg("column", ',' ORDER BY "column") FROM drift WHERE score > threshold), '') AS drifted_columns,
               count(*) FILTER (WHERE side = 'reference') AS n_reference,
               count(*) FILTER (WHERE side = 'current') AS n_current,
               min(InvoiceDate) FILTER (WHERE side = 'reference') AS reference_start,
               max(InvoiceDate) FILTER (WHERE side = 'reference') AS reference_end,
               min(InvoiceDate) FILTER (WHERE side = 'current') AS current_start,
               max(InvoiceDate) FILTER (WHERE side = 'current') AS current_end
        FROM split""",
    "run_monitor": """
        SELECT (SELECT count(*) FROM drift) AS n_columns,
               (SELECT count(*) FROM drift WHERE score > threshold) AS n_drifted_columns,
               (SELECT CAST(count(*) FILTER (WHERE score > threshold) AS DOUBLE) / count(*) FROM drift) AS drift_share,
               count(*) FILTER (WHERE side = 'reference') AS n_reference,
               count(*) FILTER (WHERE side = 'current') AS n_current
        FROM split""",
    "drift_p_values": f"""
        {P_VALUES}
        SELECT "column", method, {even('score', 6)} AS score, 0.05::DOUBLE AS threshold, score < 0.05 AS drift_detected FROM tested""",
    "split_sides": "SELECT side, count(*) AS n_rows, min(InvoiceDate) AS start, max(InvoiceDate) AS \"end\" FROM split GROUP BY side",
    "drift_display_score": f"""
        {P_VALUES}
        SELECT "column", method, {even('score', 6)} AS score, threshold, CASE WHEN pv THEN score < threshold ELSE score > threshold END AS drift_detected,
               {even('CASE WHEN pv THEN 1 - score ELSE score END', 6)} AS display_score,
               (SELECT count(*) FROM split WHERE side = 'reference') AS n_reference, (SELECT count(*) FROM split WHERE side = 'current') AS n_current,
               (SELECT min(InvoiceDate) FROM split WHERE side = 'reference') AS reference_start,
               (SELECT max(InvoiceDate) FROM split WHERE side = 'reference') AS reference_end,
               (SELECT min(InvoiceDate) FROM split WHERE side = 'current') AS current_start,
               (SELECT max(InvoiceDate) FROM split WHERE side = 'current') AS current_end
        FROM (SELECT "column", method, score, threshold, false AS pv FROM drift WHERE "column" IN ('UnitPrice', 'TotalPrice', 'DayOfWeek')
              UNION ALL SELECT "column", method, score, 0.05::DOUBLE, true FROM tested WHERE "column" IN ('Quantity', 'Hour', 'Country'))""",
    "sketch_drift_scores": f""",
        {DRIFT.format(out='at_day', cells='day_cells').replace('at_day_counts AS', DAY_CELLS + ', at_day_counts AS', 1)}
        SELECT "column", {even('score', 6)} AS score, true AS within_error FROM at_day""",
    "stratified_split": """
        SELECT churned, is_test, CASE WHEN is_test THEN t ELSE n - t END AS customers
        FROM (SELECT churned, count(*) AS n,
                     CAST(CASE WHEN churned = 1 THEN round((SELECT ceil(count(*) * 0.2) FROM churn) * count(*) / (SELECT count(*) FROM churn))
                          ELSE (SELECT ceil(count(*) * 0.2) FROM churn) - round((SELECT ceil(count(*) * 0.2) FROM churn)
                               * (SELECT count(*) FROM churn WHERE churned = 1) / (SELECT count(*) FROM churn)) END AS BIGINT) AS t
              FROM churn GROUP BY churned), (VALUES (true), (false)) s(is_test)""",
    "binary_metrics": f"""
        SELECT {even(AUC, 9)} AS auc_roc, {even('CAST(n - fp - fn AS DOUBLE) / n', 9)} AS accuracy,
               {even('CAST(tp AS DOUBLE) / (tp + fp)', 9)} AS precision, {even('CAST(tp AS DOUBLE) / (tp + fn)', 9)} AS recall,
               {even('CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn)', 9)} AS f1, CAST(n AS DOUBLE) AS n_test
        FROM ({SCORED_COUNTS})""",
    "roc_curve": f"""
        SELECT churn_probability AS threshold,
               {even('CAST(SUM(neg) OVER w AS DOUBLE) / SUM(neg) OVER ()', 9)} AS fpr,
               {even('CAST(SUM(pos) OVER w AS DOUBLE) / SUM(pos) OVER ()', 9)} AS tpr
        FROM (SELECT churn_probability, count(*) FILTER (WHERE churned = 1) AS pos,
                     count(*) FILTER (WHERE churned = 0) AS neg FROM scored GROUP BY 1)
        WINDOW w AS (ORDER BY churn_probability DESC)""",
    "check_scoring_rows": """
        SELECT *, CASE WHEN recency < 0 THEN 'recency' WHEN frequency < 0 THEN 'frequency' WHEN monetary IS NULL THEN 'monetary'
                       WHEN is_uk NOT IN (0, 1) THEN 'is_uk' END AS violation
        FROM (SELECT CustomerID, CASE WHEN CustomerID % 9 = 1 THEN -1.0::DOUBLE ELSE CAST(Recency AS DOUBLE) END AS recency,
                     CASE WHEN CustomerID % 9 = 2 THEN -3 ELSE Frequency END AS frequency,
                     CASE WHEN CustomerID % 9 = 3 THEN NULL ELSE Monetary END AS monetary,
                     CAST(CASE WHEN CustomerID % 9 = 4 THEN 2 WHEN CustomerID % 9 = 5 THEN 0 ELSE is_uk END AS INTEGER) AS is_uk,
                     0.0::DOUBLE AS avg_basket_size, 0 AS unique_products, 0.0::DOUBLE AS avg_days_between
              FROM churn)""",
    "fit_churn": MODEL_ROWS.format(models="('gbt')"),
    "compare_challenger": MODEL_ROWS.format(models="('gbt'), ('forest')"),
    "score_churn": "SELECT CustomerID, churned, true AS in_range, true AS follows_cutoff FROM churn",
    "save_and_load_model": "SELECT count(*) AS customers, 0::BIGINT AS differing FROM churn",
    "feature_importance": f"SELECT feature, true AS in_range, true AS adds_up FROM {FEATURES}",
    "importance_sort": f"SELECT feature, true AS in_order FROM {FEATURES}",
    "fit_segmenter": "SELECT count(*) AS n_customers, count(*) AS n_in_clusters, 0::BIGINT AS off_centre, true AS settled FROM rfm",
    "select_k": "SELECT CAST(unnest(range(4, 9)) AS INTEGER) AS k, true AS scored, true AS best_is_chosen",
    "score_segments": "SELECT CustomerID, true AS nearest, 1::BIGINT AS personas FROM rfm",
    "cluster_centroids": "SELECT * FROM centroids",
    "assign_personas": "SELECT * FROM personas",
    "label_personas": """
        SELECT CustomerID, c.cluster, coalesce(p.persona, 'cluster_' || c.cluster) AS persona
        FROM clustered c LEFT JOIN (SELECT * FROM personas WHERE cluster < 3) p ON p.cluster = c.cluster""",
    "persona_order_join": "SELECT DISTINCT n.persona, r.persona_rank FROM named n JOIN ranks r ON r.persona = n.persona",
    "persona_summary": f"""
        SELECT n.persona, count(*) AS n_customers, CAST(SUM(Recency) AS DOUBLE) / count(*) AS avg_recency,
               CAST(SUM(Frequency) AS DOUBLE) / count(*) AS avg_frequency, {money_mean('Monetary')} AS avg_monetary,
               {money_sum('Monetary')} AS total_monetary, max(persona_rank) AS persona_rank,
               {even('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM named) * 100.0::DOUBLE', 2)} AS share_pct
        FROM named n JOIN ranks r ON r.persona = n.persona GROUP BY n.persona""",
    "persona_distribution": f"""
        SELECT n.persona, count(*) AS customers, max(persona_rank) AS persona_rank,
               {even('CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM named) * 100.0::DOUBLE', 2)} AS share_pct
        FROM named n JOIN ranks r ON r.persona = n.persona GROUP BY n.persona""",
    "segment_headline": "SELECT count(*) AS n_customers, count(DISTINCT cluster) AS n_clusters, count(DISTINCT persona) AS n_personas FROM named",
    "centroid_distances": f"""
        SELECT CAST((SELECT count(*) FROM centroids) AS INTEGER) AS k, {even('min(d)', 4)} AS min_distance, {even('avg(d)', 4)} AS mean_distance
        FROM (SELECT sqrt(pow(a.Recency - b.Recency, 2) + pow(a.Frequency - b.Frequency, 2) + pow(a.Monetary - b.Monetary, 2)) AS d
              FROM centroids a JOIN centroids b ON a.cluster < b.cluster)""",
    "forecast_features": f"""
        SELECT 'ALL' AS series_key, InvoiceDate AS ds, {even('t', 9)} AS t,
               {even('greatest(t - 0.8::DOUBLE * 1 / 25, 0.0::DOUBLE)', 9)} AS hinge_1,
               {even('greatest(t - 0.8::DOUBLE, 0.0::DOUBLE)', 9)} AS hinge_25,
               {even('sin(2 * pi() * n / 7)', 9)} AS week_sin_1, {even('cos(2 * pi() * 3 * n / 7)', 9)} AS week_cos_3,
               {even('sin(2 * pi() * n / 365.25::DOUBLE)', 9)} AS year_sin_1,
               {even('cos(2 * pi() * 10 * n / 365.25::DOUBLE)', 9)} AS year_cos_10,
               27 AS n_trend, CAST(6 + 20 + 6 AS INTEGER) AS n_seasonal,
               CASE WHEN InvoiceDate IN (DATE '1998-12-25', DATE '1999-12-25') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS christmas
        FROM (SELECT InvoiceDate, date_diff('day', DATE '1970-01-01', InvoiceDate) AS n,
                     CAST(date_diff('day', (SELECT min(InvoiceDate) FROM daily), InvoiceDate) AS DOUBLE)
                     / date_diff('day', (SELECT min(InvoiceDate) FROM daily), (SELECT max(InvoiceDate) FROM daily)) AS t
              FROM daily)""",
    "holdout_tail": """
        SELECT Country AS series_key, is_test, n_days, min(InvoiceDate) AS first_day, count(*) AS days
        FROM (SELECT Country, InvoiceDate, InvoiceDate > max(InvoiceDate) OVER (PARTITION BY Country) - INTERVAL 30 DAY AS is_test,
                     count(*) OVER (PARTITION BY Country) AS n_days FROM daily_country)
        GROUP BY Country, is_test, n_days""",
    "holiday_calendar": HOLIDAYS,
    "series_sums": SERIES_SUMS,
    "fit_forecaster": f"SELECT series_key, 'default' AS setting, 'multiplicative' AS mode, 'full' AS fit, CAST(NULL AS VARCHAR) AS reason, first_day, last_day, n_days, true AS level_balanced FROM ({SERIES_DAYS})",
    "predict_demand": ahead(30),
    "forecast_tail": ahead(14),
    "evaluate_forecaster": f"SELECT series_key, {JUDGED} FROM ({SERIES_DAYS})",
    "forecast_grid": f"SELECT series_key, setting, {JUDGED} FROM ({SERIES_DAYS}), {GRID_SETTINGS}",
    "run_train": TRAINED.format(inventory=INVENTORY_METRICS),
    "run_promote": """
        SELECT model, metric, CASE WHEN model = 'inventory' THEN (SELECT CAST(count(*) AS DOUBLE) FROM inventory) END AS value
        FROM (VALUES ('forecasting', 'mape'), ('churn', 'auc_roc'), ('segmentation', 'silhouette'), ('inventory', 'n_skus')) m(model, metric)""",
    "forecast_metrics": f"""
        SELECT series_key, {even('avg(abs((y - yhat) / y)) FILTER (WHERE y <> 0)', 6)} AS mape,
               {even('sqrt(avg((y - yhat) * (y - yhat)))', 6)} AS rmse, count(*) AS holdout_days FROM naive GROUP BY series_key""",
    "forecast_headline": f"""
        SELECT f.series_key, {even('mean_forecast', 4)} AS mean_forecast, horizon_days, last_actual,
               {even('CASE WHEN last_actual = 0 THEN 0 ELSE (mean_forecast - last_actual) / last_actual * 100.0::DOUBLE END', 4)} AS delta_pct
        FROM (SELECT series_key, avg(yhat) AS mean_forecast, count(*) AS horizon_days FROM naive GROUP BY series_key) f,
             (SELECT arg_max(Revenue, InvoiceDate) AS last_actual FROM daily WHERE InvoiceDate <= DATE '2001-06-30')""",
    "forecast_delta_pct": f"""
        SELECT InvoiceDate, Revenue, before AS last_actual,
               {even('CASE WHEN before = 0 THEN 0 ELSE (Revenue - before) / before * 100.0::DOUBLE END', 6)} AS delta_pct
        FROM (SELECT InvoiceDate, Revenue, lag(Revenue) OVER (ORDER BY InvoiceDate) AS before FROM daily)
        WHERE before IS NOT NULL""",
    "promote_best": """
        SELECT model, metric, run_id, CAST(n AS DOUBLE) AS value
        FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY CASE WHEN model = 'forecasting' THEN n ELSE -n END, month) AS r
              FROM (SELECT m.model, m.metric, month, m.model || '-' || month AS run_id, n
                    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderkey % 4 AS i, count(*) AS n
                          FROM orders GROUP BY 1, 2) o
                    JOIN (VALUES (0, 'forecasting', 'mape'), (1, 'churn', 'auc_roc'), (2, 'segmentation', 'silhouette'),
                                 (3, 'inventory', 'n_skus')) m(i, model, metric) ON m.i = o.i
                    WHERE month(month) % 3 <> 0))
        WHERE r = 1""",
    "run_data": REPORT_ROW,
}


def all_sql() -> dict[str, str]:
    return {name: f"{CTES}\n{body.strip()}" for name, body in SPECS.items()}
