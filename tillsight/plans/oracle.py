"""The registered queries once more, as SQL over the same Parquet tables."""

from __future__ import annotations

from ..operators import insights, kmeans, segments
from ..operators.monthly import FEATURES
from ..sources.bridge import CUT_OFF
from .queries import LITERAL_WEIGHTS
from .tables import FIXED_CENTROIDS

KEY = "InvoiceNo, StockCode, Quantity, UnitPrice"
W = "OVER (PARTITION BY StockCode ORDER BY YearMonth)"
KPIS = segments.CLUSTER_FEATURES


def _quartiles(column: str, source: str) -> str:
    x = f"CAST({column} AS DOUBLE)"
    return (
        f"SELECT count({x}) AS n, min({x}) AS lo, max({x}) AS hi, quantile_cont({x}, 0.25) AS q1, "
        f"quantile_cont({x}, 0.5) AS q2, quantile_cont({x}, 0.75) AS q3 FROM {source}"
    )


def _quantile(column: str, p: float, source: str) -> str:
    """Scalar subquery for one quantile, interpolated from the nearer order statistic."""
    return f"""(SELECT CASE WHEN t < 0.5 THEN lo + (hi - lo) * t ELSE hi - (hi - lo) * (1 - t) END FROM (
      SELECT x[CAST(floor(pos) AS BIGINT) + 1] AS lo, x[CAST(ceil(pos) AS BIGINT) + 1] AS hi, pos - floor(pos) AS t
      FROM (SELECT list_sort(list(CAST({column} AS DOUBLE))) AS x, CAST({p} AS DOUBLE) * (count({column}) - 1) AS pos
        FROM {source}) AS o) AS q)"""


PROFILE = """
        SELECT CustomerID, concat(chr(10), '       Customer Profile:', chr(10), '- Orders: ', TotalOrders,
          chr(10), '- Active Months: ', ActiveMonth, chr(10), '- Avg Order Value: ', printf('%.2f', AvgOrderValue),
          chr(10), '- Recency: ', Recency, ' (', CASE WHEN Recency > 180 THEN 'inactive' ELSE 'recently active' END, ')',
          chr(10), '- Frequency: ', PurchaseFrequency, ' (',
          CASE WHEN PurchaseFrequency < 0.5 THEN 'low engagement' ELSE 'high engagement' END, ')',
          chr(10), '- Cluster: ', clusters, chr(10), '- Churn Risk: ', CASE WHEN Churn = 1 THEN 'Yes' ELSE 'No' END,
          chr(10)) AS Customer_Text"""


# Named steps in the order in which they build on each other.
STEPS = {
    "retail_base": """
        SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(l_partkey AS VARCHAR) AS StockCode,
          CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE concat('  ', upper(p_name), ' ') END AS Description,
          CAST(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -l_quantity
               WHEN l_quantity = 50 AND l_linestatus = 'O' THEN 0
               WHEN l_linenumber = 7 AND l_orderkey % 4 = 0 THEN l_quantity * 20 ELSE l_quantity END AS BIGINT) AS Quantity,
          o_orderdate AS InvoiceDate,
          CAST(CASE WHEN l_orderkey % 101 = 0 THEN 0.0E0 ELSE floor(l_extendedprice / l_quantity) / 4 END
               AS DECIMAL(12,2)) AS UnitPrice,
          CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS CustomerID,
          n_name AS Country, l_linenumber AS ln, l_orderkey AS ok
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey""",
    "raw": """
        SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM retail_base
        UNION ALL
        SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate + INTERVAL 1 DAY, UnitPrice, CustomerID, Country
        FROM retail_base WHERE ln = 1 AND ok % 10 = 0""",
    "hol_raw": """
        SELECT DISTINCT o_orderdate AS date,
          CASE WHEN n_name = 'NATION_4' THEN 'Nation Four' ELSE n_name END AS "countryOrRegion",
          CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE concat('holiday of ', n_name) END AS "holidayName"
        FROM orders JOIN nation ON day(o_orderdate) = 1 + n_nationkey % 28
        UNION ALL
        SELECT DISTINCT o_orderdate, n_name, 'Zweiter Feiertag'
        FROM orders JOIN nation ON n_nationkey = 1 AND day(o_orderdate) = 2""",
    "calendar": """
        SELECT CAST(date AS DATE) AS date, "countryOrRegion" AS countryorregion,
          trim(coalesce(min("holidayName"), 'Unknown Holiday')) AS holidayname,
          isodow(date) - 1 AS day_of_week, month(date) AS month, isodow(date) >= 6 AS is_weekend,
          last_day(date) = CAST(date AS DATE) AS month_end, day(date) = 1 AS month_start, 1 AS isholiday
        FROM hol_raw WHERE date IS NOT NULL AND "countryOrRegion" IS NOT NULL GROUP BY date, "countryOrRegion" """,
    "known": "SELECT * FROM raw WHERE CustomerID IS NOT NULL",
    "dedup": f"""
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {KEY}
          ORDER BY InvoiceDate, CustomerID, Description NULLS FIRST, Country) AS rn FROM known) AS x WHERE rn = 1""",
    "bought": """
        SELECT * REPLACE (coalesce(lower(trim(Description)), 'nan') AS Description)
        FROM dedup WHERE Quantity > 0 AND StockCode IS NOT NULL""",
    "fence": """
        SELECT *, q3 + 1.5 * (q3 - q1) AS q_up, q1 - 1.5 * (q3 - q1) AS q_low,
          p3 + 1.5 * (p3 - p1) AS p_up, p1 - 1.5 * (p3 - p1) AS p_low FROM (SELECT
          quantile_cont(CAST(Quantity AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(Quantity AS DOUBLE), 0.75) AS q3,
          quantile_cont(CAST(UnitPrice AS DOUBLE), 0.25) AS p1, quantile_cont(CAST(UnitPrice AS DOUBLE), 0.75) AS p3
          FROM bought) AS q""",
    "capped": """
        SELECT bought.* REPLACE (least(CAST(Quantity AS DECIMAL(12,3)), CAST(q_up AS DECIMAL(12,3))) AS Quantity)
        FROM bought, fence""",
    "priced": """
        SELECT capped.* FROM capped, fence WHERE UnitPrice > 0 AND CAST(UnitPrice AS DOUBLE) < p_up""",
    "clean": """
        SELECT p.InvoiceNo, p.StockCode, p.Description, p.Quantity, CAST(p.InvoiceDate AS DATE) AS InvoiceDate,
          p.UnitPrice, p.CustomerID, p.Country, p.Quantity * p.UnitPrice AS Revenue, year(p.InvoiceDate) AS "Year",
          month(p.InvoiceDate) AS Month_num, isodow(p.InvoiceDate) - 1 AS day_of_week, week(p.InvoiceDate) AS week,
          CAST(date_trunc('month', min(p.InvoiceDate) OVER (PARTITION BY p.CustomerID)) AS DATE) AS CohortMonth,
          coalesce(c.holidayname, 'Non-holiday') AS holidayname, coalesce(c.isholiday, 0) AS isholiday,
          p.Quantity * coalesce(c.isholiday, 0) AS HolidayQuantity,
          CAST(date_trunc('month', p.InvoiceDate) AS DATE) AS YearMonth
        FROM priced p LEFT JOIN calendar c ON CAST(p.InvoiceDate AS DATE) = c.date
          AND CASE WHEN trim(p.Country) = 'NATION_4' THEN 'Nation Four' ELSE trim(p.Country) END = c.countryorregion
        WHERE p.InvoiceNo IS NOT NULL AND p.StockCode IS NOT NULL AND p.InvoiceDate IS NOT NULL""",
    "monthly": """
        SELECT StockCode, YearMonth, sum(Quantity) AS MonthlyQuantity,
          CAST(sum(UnitPrice) AS DOUBLE) / count(UnitPrice) AS AvgUnitPrice, CAST(sum(isholiday) AS BIGINT) AS HolidayCount,
          sum(Revenue) AS MonthlyRevenue, sum(HolidayQuantity) AS TotalHolidayQuantity
        FROM clean GROUP BY StockCode, YearMonth""",
    "features": f"""
        SELECT * FROM (SELECT StockCode, YearMonth, CAST(MonthlyQuantity AS DOUBLE) AS MonthlyQuantity, AvgUnitPrice,
          HolidayCount, CAST(MonthlyRevenue AS DOUBLE) AS MonthlyRevenue,
          {", ".join(f'CAST(lag(MonthlyQuantity, {k}) {W} AS DOUBLE) AS lag{k}_quantity' for k in (1, 2, 3))},
          CAST(lag(MonthlyQuantity, 1) {W} + lag(MonthlyQuantity, 2) {W} + lag(MonthlyQuantity, 3) {W} AS DOUBLE) / 3
            AS rolling_mean_3,
          CAST(MonthlyQuantity AS DOUBLE) / nullif(CAST(lag(MonthlyQuantity, 1) {W} AS DOUBLE), 0) - 1 AS GrowthRate,
          month(YearMonth) AS "Month",
          {", ".join(f'CAST(lag(MonthlyRevenue, {k}) {W} AS DOUBLE) AS LagRevenue{k}' for k in (1, 2, 3))}
        FROM monthly) AS f WHERE lag3_quantity IS NOT NULL AND GrowthRate IS NOT NULL""",
    "dataset": f"""
        SELECT * FROM (SELECT *, lead(MonthlyQuantity, 1) {W} AS target FROM features
          WHERE YearMonth < (SELECT max(YearMonth) FROM features)) AS d WHERE target IS NOT NULL""",
    "train": f"SELECT * FROM dataset WHERE YearMonth <= DATE '{CUT_OFF}'",
    "test": f"SELECT * FROM dataset WHERE YearMonth > DATE '{CUT_OFF}'",
    "rollup": """
        SELECT StockCode, CAST(sum(MonthlyQuantity) AS DOUBLE) AS TotalQuantitySold,
          CAST(sum(MonthlyRevenue) AS DOUBLE) AS TotalRevenue,
          CAST(sum(MonthlyQuantity) AS DOUBLE) / count(*) AS AvgMonthlyQuantity,
          CAST(sum(MonthlyRevenue) AS DOUBLE) / count(*) AS AvgMonthlyRevenue, count(DISTINCT YearMonth) AS ActiveMonthCount,
          sqrt(CASE WHEN count(*) > 1 THEN CAST(count(*) * sum(MonthlyQuantity * MonthlyQuantity)
            - sum(MonthlyQuantity) * sum(MonthlyQuantity) AS DOUBLE)
            / (CAST(count(*) AS DOUBLE) * (CAST(count(*) AS DOUBLE) - 1)) END) AS StdMonthlyQuantity,
          CAST(max(MonthlyQuantity) AS DOUBLE) AS PeakMonthSale,
          CAST(sum(TotalHolidayQuantity) AS DOUBLE) AS TotalHolidayQuantity
        FROM (SELECT * REPLACE (CAST(MonthlyQuantity AS DECIMAL(15,3)) AS MonthlyQuantity) FROM monthly) AS m
        GROUP BY StockCode""",
    "pricing": """
        SELECT StockCode, CAST(sum(UnitPrice) AS DOUBLE) / count(*) AS AvgUnitPrice,
          CASE WHEN count(*) > 1 THEN CAST(count(*) * sum(UnitPrice * UnitPrice) - sum(UnitPrice) * sum(UnitPrice) AS DOUBLE)
            / (CAST(count(*) AS DOUBLE) * (CAST(count(*) AS DOUBLE) - 1)) END AS PriceVariance
        FROM clean GROUP BY StockCode""",
    "reach": "SELECT StockCode, count(DISTINCT CustomerID) AS UniqueCustomersCount FROM clean GROUP BY StockCode",
    "product": """
        SELECT r.*, coalesce(TotalHolidayQuantity / nullif(TotalQuantitySold, 0), 0) AS HolidayRatio, AvgUnitPrice,
          PriceVariance, UniqueCustomersCount
        FROM rollup r LEFT JOIN pricing USING (StockCode) LEFT JOIN reach USING (StockCode)""",
    "order_value": """
        SELECT InvoiceNo, CustomerID, sum(Quantity * UnitPrice) AS value FROM clean GROUP BY InvoiceNo, CustomerID""",
    "aov": "SELECT CustomerID, CAST(sum(value) AS DOUBLE) / count(*) AS AvgOrderValue FROM order_value GROUP BY CustomerID",
    "kpi_raw": """
        SELECT c.CustomerID, TotalOrders, ActiveMonth, AvgOrderValue, Recency,
          CAST(TotalOrders AS DOUBLE) / ActiveMonth AS PurchaseFrequency
        FROM (SELECT CustomerID, count(DISTINCT InvoiceNo) AS TotalOrders, count(DISTINCT YearMonth) AS ActiveMonth,
          date_diff('day', max(InvoiceDate), (SELECT max(InvoiceDate) FROM clean)) AS Recency
          FROM clean GROUP BY CustomerID) AS c JOIN aov USING (CustomerID)""",
    "kpi": f"""
        SELECT CustomerID, TotalOrders, ActiveMonth,
          {", ".join(f"least(greatest(CAST({c} AS DOUBLE), lo_{c}), hi_{c}) AS {c}" for c in ("AvgOrderValue", "Recency", "PurchaseFrequency"))}
        FROM kpi_raw, (SELECT {", ".join(f"{_quantile(c, p, 'kpi_raw')} AS {n}_{c}"
          for c in ("AvgOrderValue", "Recency", "PurchaseFrequency") for p, n in ((0.01, "lo"), (0.99, "hi")))}) AS b""",
    "z": f"""
        SELECT CustomerID, {", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in KPIS)}
        FROM kpi, (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in KPIS)} FROM kpi) AS s""",
    "distances": "SELECT *, " + ", ".join(
        "(" + " + ".join(f"({c} - ({v})) * ({c} - ({v}))" for c, v in zip(KPIS, centroid)) + f") AS d{i}"
        for i, centroid in enumerate(FIXED_CENTROIDS)
    ) + " FROM z",
    "assigned": "SELECT *, CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS clusters FROM distances",
    "segment": f"""
        SELECT kpi.*, clusters, CASE WHEN Recency > 180 THEN 1 ELSE 0 END AS Churn,
          CASE clusters WHEN 0 THEN '{segments.FREQUENT}' WHEN 1 THEN '{segments.OCCASIONAL}'
            WHEN 2 THEN '{segments.DORMANT}' END AS segment
        FROM kpi JOIN (SELECT CustomerID, clusters FROM assigned) AS a USING (CustomerID)""",
    "texts": f"{PROFILE} FROM segment",
}


def _sql(final: str, *steps: str) -> str:
    """``final`` after the steps it names, each with all steps before it."""
    last = max(list(STEPS).index(s) for s in steps) if steps else -1
    chosen = list(STEPS.items())[: last + 1]
    return ("WITH " + ",\n".join(f"{n} AS ({s})" for n, s in chosen) + "\n" if chosen else "") + final


def _k_means(final: str, runs: str) -> str:
    """``final`` after K-Means runs (a query of run and k): draws and Lloyd's steps are recursive steps.

    ``pts`` has the customers on the grid (p, a list), ``fitted`` the centers of each run (c, a list of lists),
    ``near`` each customer once a run with its cluster i (from 1) and squared distance d.
    """
    n = range(1, len(KPIS) + 1)
    grid = ", ".join(f"CAST(floor({c} * {kmeans.GRID} + 0.5) AS BIGINT)" for c in KPIS)
    distances = "list_transform(c, lambda q: " + " + ".join(f"(p[{j}] - q[{j}]) * (p[{j}] - q[{j}])" for j in n) + ")"
    # the shift makes the division of integers round down below zero as well
    middle = ", ".join(f"CAST((2 * sum(p[{j}]) + count(*) + 2000000000000 * count(*)) // (2 * count(*)) - 1000000000000 AS BIGINT)" for j in n)
    steps = f"""pts AS MATERIALIZED (SELECT CustomerID, [{grid}] AS p FROM z),
    seeding AS (SELECT run, k, 0 AS step, CAST([] AS BIGINT[][]) AS c FROM ({runs}) AS r
      UNION ALL
      SELECT run, any_value(k), step + 1, list_append(any_value(c), arg_min(p, draw)) FROM (
        SELECT run, k, step, c, p, -ln((CAST('0x' || substr(md5(concat_ws('|', 42, run, step, CustomerID)), 1, 13) AS BIGINT) + 1)
          / 4503599627370496.0E0) / weight AS draw
        FROM (SELECT *, coalesce(list_min({distances}), 1) AS weight FROM seeding, pts WHERE step < k) AS w WHERE weight > 0) AS d
      GROUP BY run, step),
    lloyd AS (SELECT run, 0 AS it, true AS moved, arg_max(c, step) AS c FROM seeding GROUP BY run
      UNION ALL
      SELECT run, it + 1, moved_to <> c, moved_to FROM (
        SELECT run, it, c, list_transform(c, lambda q, i: coalesce(found[i], q)) AS moved_to FROM (
          SELECT run, it, any_value(c) AS c, map(list(i), list(m)) AS found FROM (
            SELECT run, it, any_value(c) AS c, i, [{middle}] AS m FROM (
              SELECT run, it, c, p, list_position(ds, list_min(ds)) AS i
              FROM (SELECT run, it, c, p, {distances} AS ds FROM lloyd, pts WHERE moved AND it < 300) AS a) AS b
            GROUP BY run, it, i) AS e GROUP BY run, it) AS f) AS g),
    fitted AS MATERIALIZED (SELECT run, arg_max(c, it) AS c FROM lloyd GROUP BY run),
    near AS MATERIALIZED (SELECT run, c, CustomerID, p, list_position(ds, list_min(ds)) AS i, list_min(ds) AS d
      FROM (SELECT *, {distances} AS ds FROM fitted, pts) AS a)"""
    return _sql(f",\n{steps}\n{final}", "z").replace("WITH ", "WITH RECURSIVE ", 1)


def _k_means_queries() -> dict[str, str]:
    scan = "SELECT unnest(range(2, 15)) AS run, unnest(range(2, 15)) AS k"
    recency, orders = KPIS.index("Recency") + 1, KPIS.index("TotalOrders") + 1
    names = f"""named AS (SELECT c, dormant, list_position(rest, list_max(rest)) AS frequent FROM (
        SELECT c, dormant, list_transform(c, lambda q, i: CASE WHEN i = dormant THEN NULL ELSE q[{orders}] END) AS rest FROM (
          SELECT c, list_position(list_transform(c, lambda q: q[{recency}]), list_max(list_transform(c, lambda q: q[{recency}]))) AS dormant
          FROM fitted WHERE run = (SELECT run FROM near GROUP BY run ORDER BY sum(d), run LIMIT 1)) AS a) AS b),
    labelled AS (SELECT kpi.*, CAST(i - 1 AS INTEGER) AS clusters, CASE WHEN Recency > 180 THEN 1 ELSE 0 END AS Churn,
        CASE i WHEN dormant THEN '{segments.DORMANT}' WHEN frequent THEN '{segments.FREQUENT}'
          ELSE '{segments.OCCASIONAL}' END AS segment
      FROM kpi JOIN near USING (CustomerID) JOIN named ON near.c = named.c
      WHERE run = (SELECT run FROM near GROUP BY run ORDER BY sum(d), run LIMIT 1))"""
    apart = " + ".join(f"pow(CAST(x.p[{j}] - y.p[{j}] AS DOUBLE), 2)" for j in range(1, len(KPIS) + 1))
    return {
        "customer_segments": _k_means(
            f", {names}, texts AS ({PROFILE} FROM labelled) SELECT * FROM labelled JOIN texts USING (CustomerID)",
            "SELECT unnest(range(0, 10)) AS run, 3 AS k"),
        "elbow": _k_means(f"SELECT CAST(run AS INTEGER) AS k, CAST(sum(d) AS DOUBLE) / {kmeans.GRID**2} AS wcss FROM near GROUP BY run", scan),
        "silhouette_by_k": _k_means(f"""
            , pair AS (SELECT x.run, x.CustomerID, x.i AS own, y.i AS other, count(*) AS n, sum({apart}) / {kmeans.GRID**2} AS d
              FROM near x JOIN near y ON x.run = y.run GROUP BY ALL),
            ab AS (SELECT run, CustomerID, max(CASE WHEN own = other THEN n END) AS n,
                max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a,
                min(CASE WHEN own <> other THEN d / n END) AS b FROM pair GROUP BY run, CustomerID)
            SELECT CAST(run AS INTEGER) AS k,
              round(avg(CASE WHEN n > 1 THEN coalesce((b - a) / nullif(greatest(a, b), 0), 0) ELSE 0 END), 6) AS silhouette
            FROM ab GROUP BY run""", scan),
        "k_comparison": _k_means(
            "SELECT CAST(run AS INTEGER) AS k, CAST(i - 1 AS INTEGER) AS clusters, "
            + ", ".join(f"round(avg({c}), 6) AS {c}" for c in KPIS)
            + ", count(*) AS customers FROM near JOIN kpi USING (CustomerID) WHERE run IN (2, 3, 4) GROUP BY run, i", scan),
    }


def _ridge(final: str, label: str = "MonthlyQuantity") -> str:
    """``final`` after a ridge fit: normal equations per (fold, alpha), solved by elimination in a recursive step.

    ``fit`` has (fold, alpha, intercept, w raw-scale, z standardised), fold 6 being all training rows;
    ``score`` has the fold errors, ``best`` the chosen fit, ``mu`` the training means as a list.
    """
    p = len(FEATURES)
    x = [f"(CAST({f} AS DOUBLE) - o[{i}])" for i, f in enumerate(FEATURES, 1)]
    cells = ["1.0E0", *x, "CAST(target AS DOUBLE)"]
    gram = ", ".join("[" + ", ".join(f"sum(({a}) * ({b}))" for b in cells) + "]" for a in cells)
    guess = _predicted("fit")
    rows = f"""lb AS (SELECT * FROM (SELECT *, lead({label}, 1) {W} AS target FROM features
      WHERE YearMonth < (SELECT max(YearMonth) FROM features)) AS d WHERE target IS NOT NULL),
    tr AS MATERIALIZED (SELECT * EXCLUDE (rn, n), CASE WHEN rn < n - 5 * (n // 6) THEN 0
        ELSE 1 + (rn - (n - 5 * (n // 6))) // (n // 6) END AS block
      FROM (SELECT *, row_number() OVER (ORDER BY YearMonth, StockCode) - 1 AS rn, count(*) OVER () AS n
        FROM lb WHERE YearMonth <= DATE '{CUT_OFF}') AS q),
    te AS MATERIALIZED (SELECT * FROM lb WHERE YearMonth > DATE '{CUT_OFF}'),
    mu AS MATERIALIZED (SELECT [{", ".join(f"avg(CAST({f} AS DOUBLE))" for f in FEATURES)}] AS o FROM tr),
    gram AS MATERIALIZED (SELECT fold, [{gram}] AS g FROM tr, mu, (SELECT unnest(range(1, 7)) AS fold) AS f
      WHERE block < fold GROUP BY fold),
    stat AS (SELECT fold, g, g[1][1] AS n, list_transform(range(2, {p + 2}), lambda i: g[1][i] / g[1][1]) AS mx,
        g[1][{p + 2}] / g[1][1] AS my,
        list_transform(range(2, {p + 2}), lambda i: CASE WHEN g[i][i] / g[1][1] - pow(g[1][i] / g[1][1], 2) > 0
          THEN sqrt(g[i][i] / g[1][1] - pow(g[1][i] / g[1][1], 2)) ELSE 1.0E0 END) AS sd FROM gram),
    sys AS MATERIALIZED (SELECT fold, alpha, my, mx, sd, list_transform(range(1, {p + 1}), lambda i:
        list_transform(range(1, {p + 2}), lambda j: CASE
          WHEN j = {p + 1} THEN n * (g[i + 1][{p + 2}] / n - mx[i] * my) / sd[i]
          ELSE n * (g[i + 1][j + 1] / n - mx[i] * mx[j]) / (sd[i] * sd[j]) + CASE WHEN i = j THEN alpha ELSE 0 END END)) AS m
      FROM stat, (SELECT unnest([0.1E0, 1.0E0, 10.0E0, 50.0E0, 100.0E0]) AS alpha) AS a),
    elim AS (SELECT fold, alpha, 1 AS k, m FROM sys
      UNION ALL
      SELECT fold, alpha, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END) FROM elim WHERE k <= {p}),
    sol AS (SELECT sys.*, list_transform(elim.m, lambda r: r[{p + 1}]) AS z
      FROM sys JOIN elim USING (fold, alpha) WHERE k = {p + 1}),
    wt AS (SELECT fold, alpha, my, mx, z, list_transform(z, lambda v, i: v / sd[i]) AS w FROM sol),
    fit AS MATERIALIZED (SELECT fold, alpha, z, w, my - list_sum(list_transform(w, lambda v, i: v * (mx[i] + o[i]))) AS intercept
      FROM wt, mu),
    score AS MATERIALIZED (SELECT alpha, fold, count(*) AS test_rows, sqrt(avg(pow(target - ({guess}), 2))) AS rmse
      FROM tr JOIN fit ON block = fold GROUP BY alpha, fold),
    best AS MATERIALIZED (SELECT * FROM fit WHERE fold = 6 AND alpha = (SELECT alpha FROM
      (SELECT alpha, avg(rmse) AS e FROM score GROUP BY alpha) AS s ORDER BY e, alpha LIMIT 1))"""
    return _sql(f",\n{rows}\n{final}", "features").replace("WITH ", "WITH RECURSIVE ", 1)


def _predicted(fit: str) -> str:
    return f"{fit}.intercept + " + " + ".join(f"{fit}.w[{i}] * {f}" for i, f in enumerate(FEATURES, 1))


def _ridge_queries() -> dict[str, str]:
    guess = _predicted("best")
    features = "unnest([" + ", ".join(f"'{f}'" for f in FEATURES) + "])"
    metrics = f"""SELECT n AS rows, round(ae / n, 5) AS "MAE", round(sqrt(se / n), 5) AS "RMSE",
        round(1 - se / (yy - y * y / n), 5) AS "R2" FROM (SELECT count(*) AS n, sum(abs(target - ({guess}))) AS ae,
        sum(pow(target - ({guess}), 2)) AS se, sum(target) AS y, sum(target * target) AS yy FROM te, best) AS x"""
    middle = f"""SELECT StockCode, YearMonth, target AS actual, {guess} AS guess FROM te, best
        ORDER BY abs(target - ({guess})), StockCode, YearMonth LIMIT 1 OFFSET (SELECT count(*) // 2 FROM te)"""
    long = ", shap AS (" + " UNION ALL ".join(
        f"SELECT StockCode, YearMonth, {i} AS i, '{f}' AS \"Feature\", CAST({f} AS DOUBLE) AS \"Value\", w[{i}] * ({f} - o[{i}]) "
        "AS phi, intercept + list_sum(list_transform(w, lambda v, j: v * o[j])) AS base FROM te, best, mu"
        for i, f in enumerate(FEATURES, 1)
    ) + """), imp AS (SELECT CAST(row_number() OVER (ORDER BY v DESC, "Feature") AS INTEGER) AS "Rank", "Feature",
        round(v, 5) AS "MeanAbsoluteSHAP", round(z[i], 5) + 0.0E0 AS "StandardizedRidgeCoefficient"
        FROM (SELECT i, "Feature", avg(abs(phi)) AS v FROM shap GROUP BY i, "Feature") AS a, best)"""
    values = 'StockCode, YearMonth, round(base, 5) AS "BaseValue", "Feature", "Value", round(phi, 5) + 0.0E0 AS "SHAP"'
    return {
        "cv_scores": _ridge(
            "SELECT alpha, CAST(fold AS INTEGER) AS fold, (SELECT count(*) FROM tr WHERE block < fold) AS train_rows, test_rows, "
            "round(rmse, 5) AS rmse FROM score"),
        "ridge_fit": _ridge(
            f'SELECT {features} AS "Feature", unnest(list_transform(w, lambda v: round(v, 6) + 0.0E0)) AS weight, '
            "unnest(list_transform(z, lambda v: round(v, 6) + 0.0E0)) AS standardized, round(intercept, 6) AS intercept, alpha FROM best"),
        "predictions": _ridge(f'SELECT te.*, round({guess}, 5) AS "Predicted" FROM te, best'),
        "model_metrics": _ridge(metrics),
        "revenue_forecast": _ridge(metrics, "MonthlyRevenue"),
        "next_month_forecast": _ridge(
            f'SELECT StockCode, YearMonth, round({guess}, 5) AS "Predicted" FROM features, best '
            "QUALIFY row_number() OVER (PARTITION BY StockCode ORDER BY YearMonth DESC) = 1"),
        "shap_values": _ridge(f"{long} SELECT {values} FROM shap"),
        "shap_importance": _ridge(f"{long} SELECT * FROM imp"),
        "shap_top_features": _ridge(f'{long} SELECT * FROM imp WHERE "Rank" <= 10'),
        "shap_beeswarm": _ridge(f'{long} SELECT {values}, "Rank" FROM shap JOIN imp USING ("Feature") WHERE "Rank" <= 10'),
        "shap_representative": _ridge(
            'SELECT StockCode, YearMonth, actual AS "ActualNextMonthQuantity", round(guess, 5) AS "PredictedNextMonthQuantity", '
            f'round(abs(actual - guess), 5) AS "AbsoluteError" FROM ({middle}) AS x'),
        "shap_local": _ridge(f"""{long},
            one AS (SELECT shap.*, least(row_number() OVER (ORDER BY abs(phi) DESC, "Feature"), 10) AS r
              FROM shap JOIN ({middle}) AS x USING (StockCode, YearMonth))
            SELECT StockCode, YearMonth, round(base, 5) AS "BaseValue", CAST(r AS INTEGER) AS "Rank", CASE WHEN count(*) > 1
              THEN concat(count(*), ' other features') ELSE max("Feature") END AS "Feature", round(sum(phi), 5) + 0.0E0 AS "SHAP"
            FROM one GROUP BY StockCode, YearMonth, base, r"""),
        "shap_background": _sql(
            "SELECT * FROM train ORDER BY md5(concat('42|', StockCode, '|', CAST(YearMonth AS VARCHAR))), StockCode, YearMonth "
            "LIMIT 500", "train"),
        "sample_member": _sql(
            f"SELECT * FROM segment WHERE segment = '{segments.FREQUENT}' ORDER BY md5(concat('42|', CustomerID)), CustomerID "
            "LIMIT 1", "segment"),
    }


def _histogram(column: str, source: str, step: str) -> str:
    """Bins as numpy's 'auto' rule sets them, the last one closed."""
    edge = "CASE WHEN {i} = bins THEN hi ELSE lo + {i} * step END"
    guess = "least(CAST(floor((v - lo) / (hi - lo) * bins) AS BIGINT), bins - 1)"
    return _sql(f"""
        , s AS ({_quartiles(column, source)}),
        b AS (SELECT lo, hi, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
            greatest(2.0E0 * (q3 - q1) / pow(n, 1.0E0 / 3.0E0), (hi - lo) / sqrt(n) / 2))) AS BIGINT) AS bins FROM s),
        e AS (SELECT *, (hi - lo) / bins AS step FROM b),
        g AS (SELECT v, lo, hi, bins, step, {guess} AS i FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {source}) AS x, e),
        p AS (SELECT i - CASE WHEN v < {edge.format(i='i')} THEN 1 ELSE 0 END
            + CASE WHEN v >= {edge.format(i='(i + 1)')} AND i < bins - 1 THEN 1 ELSE 0 END AS bin FROM g),
        c AS (SELECT bin, count(*) AS lines FROM p GROUP BY bin)
        SELECT r.bin, {edge.format(i='r.bin')} AS left_edge, {edge.format(i='(r.bin + 1)')} AS right_edge,
          coalesce(lines, 0) AS lines
        FROM (SELECT lo, hi, step, bins, unnest(range(bins)) AS bin FROM e) AS r LEFT JOIN c ON c.bin = r.bin""", step)


def _box(column: str) -> str:
    return _sql(f"""
        , s AS (SELECT *, q1 - 1.5 * (q3 - q1) AS f_lo, q3 + 1.5 * (q3 - q1) AS f_hi FROM ({_quartiles(column, 'clean')}) AS q),
        w AS (SELECT least(min(CASE WHEN CAST({column} AS DOUBLE) >= f_lo THEN CAST({column} AS DOUBLE) END), min(q1)) AS whisker_low,
          greatest(max(CASE WHEN CAST({column} AS DOUBLE) <= f_hi THEN CAST({column} AS DOUBLE) END), min(q3)) AS whisker_high
          FROM clean, s)
        SELECT q1, q2 AS median, q3, whisker_low, whisker_high, (SELECT count(*) FROM clean, w
          WHERE CAST({column} AS DOUBLE) < whisker_low OR CAST({column} AS DOUBLE) > whisker_high) AS fliers FROM s, w""", "clean")


def _describe(source: str, step: str, *columns: str) -> str:
    def one(c):
        return f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
          round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std,
          CAST(min({c}) AS DOUBLE) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
          quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75,
          CAST(max({c}) AS DOUBLE) AS max FROM {source}"""

    return _sql(" UNION ALL ".join(map(one, columns)), step)


def _nulls(source: str, step: str, columns: str) -> str:
    return _sql(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS nulls FROM {source}" for c in columns.split()
    ), step)


def _duplicates(source: str, step: str, key: str, columns: str) -> str:
    return _sql(f"""
        SELECT (SELECT count(*) FROM {source}) AS rows,
          (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}) AS a) AS repeated_rows,
          (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {source}) AS b) AS repeated_keys""", step)


def _total(key: str, column: str) -> str:
    return _sql(f"SELECT {key}, CAST(sum({column}) AS DOUBLE) AS {column} FROM clean GROUP BY {key}", "clean")


def _text(value: str) -> str:
    return " || chr(10) || ".join("'" + line.replace("'", "''") + "'" for line in value.split("\n"))


RAW = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
RAW_DOUBLE = RAW.replace("UnitPrice", "CAST(UnitPrice AS DOUBLE) AS UnitPrice")
CAPPED = RAW_DOUBLE.replace("Quantity", "CAST(Quantity AS DOUBLE) AS Quantity")
CLEAN = """InvoiceNo, StockCode, Description, CAST(Quantity AS DOUBLE) AS Quantity, InvoiceDate,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country, CAST(Revenue AS DOUBLE) AS Revenue, "Year", Month_num,
  day_of_week, week, CohortMonth, holidayname, isholiday, CAST(HolidayQuantity AS DOUBLE) AS HolidayQuantity, YearMonth"""
SUMMARY = ", ".join(f"round(avg({c}), 6) AS {c}" for c in segments.SUMMARY)


def oracle() -> dict[str, str]:
    phi = {f: f"({w!r}) * ({f} - m_{f})" for f, w in zip(FEATURES, LITERAL_WEIGHTS)}
    return {
        **_ridge_queries(),
        **_k_means_queries(),
        # sources and cleaning
        "retail_raw": _sql(f"SELECT {RAW_DOUBLE} FROM raw", "raw"),
        "holidays_raw": _sql("SELECT * FROM hol_raw", "hol_raw"),
        "drop_null_customer": _sql(f"SELECT {RAW_DOUBLE} FROM known", "known"),
        "dedup_lines": _sql(f"SELECT {RAW_DOUBLE} FROM dedup", "dedup"),
        "split_counts": _sql(
            "SELECT CASE WHEN Quantity > 0 THEN 'purchase' WHEN Quantity = 0 THEN 'invalid' ELSE 'return' END AS kind, "
            "count(*) AS lines FROM dedup GROUP BY 1", "dedup"),
        "returns": _sql(f"SELECT {RAW_DOUBLE} FROM dedup WHERE Quantity < 0", "dedup"),
        "invalid_lines": _sql(f"SELECT {RAW_DOUBLE} FROM dedup WHERE Quantity = 0", "dedup"),
        "text_standardize": _sql(
            "SELECT InvoiceNo, StockCode, coalesce(lower(trim(Description)), 'nan') AS Description FROM raw "
            "WHERE StockCode IS NOT NULL", "raw"),
        "text_strip_special": _sql(
            "SELECT InvoiceNo, StockCode, regexp_replace(lower(trim(Description)), '[^a-z0-9 ]', '', 'g') AS Description "
            "FROM raw WHERE StockCode IS NOT NULL", "raw"),
        "iqr_fences": _sql(
            "SELECT 'Quantity' AS \"column\", q1, q3, q_low AS lower, q_up AS upper FROM fence UNION ALL "
            "SELECT 'UnitPrice', p1, p3, p_low, p_up FROM fence", "fence"),
        "cap_quantity": _sql(f"SELECT {CAPPED} FROM capped", "capped"),
        "filter_price": _sql(
            f"SELECT {RAW_DOUBLE} FROM bought, fence WHERE UnitPrice > 0 AND CAST(UnitPrice AS DOUBLE) < p_up", "fence"),
        "quantity_outliers": _sql(f"SELECT {RAW_DOUBLE} FROM bought, fence WHERE CAST(Quantity AS DOUBLE) > q_up", "fence"),
        "price_outliers": _sql(
            f"SELECT {RAW_DOUBLE}, CASE WHEN CAST(UnitPrice AS DOUBLE) >= p_up THEN 'above' ELSE 'below' END AS side "
            "FROM bought, fence WHERE CAST(UnitPrice AS DOUBLE) >= p_up OR CAST(UnitPrice AS DOUBLE) <= greatest(p_low, 0)",
            "fence"),
        "calendar_parts": _sql(
            "SELECT InvoiceNo, StockCode, InvoiceDate, year(InvoiceDate) AS \"Year\", month(InvoiceDate) AS \"Month\", "
            "isodow(InvoiceDate) - 1 AS day_of_week, week(InvoiceDate) AS week FROM raw", "raw"),
        "holiday_calendar": _sql("SELECT * FROM calendar", "calendar"),
        "holiday_calendar_by_name": _sql("""
            SELECT CAST(date AS DATE) AS date,
              list_aggregate(list_transform(string_split(lower("countryOrRegion"), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS countryorregion,
              list_aggregate(list_transform(string_split(lower("holidayName"), ' '), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS holidayname,
              isodow(date) - 1 AS day_of_week, month(date) AS month, isodow(date) >= 6 AS is_weekend,
              last_day(date) = CAST(date AS DATE) AS month_end, day(date) = 1 AS month_start,
              CASE WHEN "holidayName" IS NULL THEN 0 ELSE 1 END AS isholiday
            FROM (SELECT DISTINCT * FROM hol_raw) AS h""", "hol_raw"),
        "country_alias": _sql(
            "SELECT Country, CASE WHEN trim(Country) = 'NATION_4' THEN 'Nation Four' ELSE trim(Country) END AS holiday_country, "
            "count(*) AS lines FROM raw GROUP BY 1, 2", "raw"),
        "holiday_enrich": _sql("""
            SELECT InvoiceNo, StockCode, Quantity, CAST(InvoiceDate AS DATE) AS InvoiceDate, Country,
              coalesce(holidayname, 'Non-holiday') AS holidayname, coalesce(isholiday, 0) AS isholiday,
              Quantity * coalesce(isholiday, 0) AS HolidayQuantity
            FROM raw LEFT JOIN calendar ON CAST(InvoiceDate AS DATE) = date
              AND CASE WHEN trim(Country) = 'NATION_4' THEN 'Nation Four' ELSE trim(Country) END = countryorregion""", "calendar"),
        "key_uniqueness": _sql(
            'SELECT CAST(date AS DATE) AS date, "countryOrRegion", count(*) AS rows FROM hol_raw GROUP BY 1, 2 '
            "HAVING count(*) > 1", "hol_raw"),
        "revenue_sign_check": _sql(
            "SELECT count(*) FILTER (WHERE Quantity * UnitPrice < 0) AS negative_lines, "
            "count(*) FILTER (WHERE Quantity * UnitPrice = 0) AS zero_lines, count(*) AS lines FROM raw", "raw"),
        "cohort_month": _sql("SELECT DISTINCT CustomerID, CohortMonth FROM clean", "clean"),
        "retail_clean": _sql(f"SELECT {CLEAN} FROM clean", "clean"),
        # products
        "monthly_product": _sql(
            "SELECT * REPLACE (CAST(MonthlyQuantity AS DOUBLE) AS MonthlyQuantity, CAST(MonthlyRevenue AS DOUBLE) AS "
            "MonthlyRevenue, CAST(TotalHolidayQuantity AS DOUBLE) AS TotalHolidayQuantity) FROM monthly", "monthly"),
        "product_rollup": _sql("SELECT * FROM rollup", "rollup"),
        "product_pricing": _sql("SELECT * FROM pricing", "pricing"),
        "product_reach": _sql("SELECT * FROM reach", "reach"),
        "product_kpis": _sql("SELECT * FROM product", "product"),
        # customers
        "total_orders": _sql("SELECT CustomerID, TotalOrders FROM kpi_raw", "kpi_raw"),
        "recency": _sql("SELECT CustomerID, Recency FROM kpi_raw", "kpi_raw"),
        "avg_order_value": _sql("SELECT * FROM aov", "aov"),
        "active_months": _sql("SELECT CustomerID, ActiveMonth FROM kpi_raw", "kpi_raw"),
        "customer_kpis_raw": _sql("SELECT * FROM kpi_raw", "kpi_raw"),
        "customer_kpis": _sql("SELECT * FROM kpi", "kpi"),
        # trends and top lists
        "monthly_revenue": _total("YearMonth", "Revenue"),
        "monthly_quantity": _total("YearMonth", "Quantity"),
        "weekly_revenue": _total("week", "Revenue"),
        "weekday_revenue": _sql(
            "SELECT dayname(InvoiceDate) AS \"Days\", CAST(sum(Revenue) AS DOUBLE) AS Revenue FROM clean GROUP BY 1", "clean"),
        "orders_per_customer": _sql(
            "SELECT CustomerID, count(DISTINCT InvoiceNo) AS Orders FROM clean GROUP BY CustomerID", "clean"),
        "revenue_per_customer": _total("CustomerID", "Revenue"),
        "customer_orders_revenue": _sql(
            "SELECT CustomerID, count(DISTINCT InvoiceNo) AS Orders, CAST(sum(Revenue) AS DOUBLE) AS revenue FROM clean "
            "GROUP BY CustomerID", "clean"),
        "top10_revenue": _sql(
            "SELECT Description AS Product, CAST(sum(Revenue) AS DOUBLE) AS Revenue FROM clean GROUP BY Description "
            "ORDER BY 2 DESC, Description LIMIT 10", "clean"),
        "top10_quantity": _sql(
            "SELECT Description AS Product, CAST(sum(Quantity) AS DOUBLE) AS Quantity FROM clean GROUP BY Description "
            "ORDER BY 2 DESC, Description LIMIT 10", "clean"),
        # profiles
        "dataset_card": _sql(
            "SELECT count(DISTINCT InvoiceNo) AS invoices, count(DISTINCT StockCode) AS products, "
            "count(DISTINCT CustomerID) AS customers, min(InvoiceDate) AS first_date, max(InvoiceDate) AS last_date, "
            "count(*) AS lines FROM clean", "clean"),
        "quantity_center": _sql(
            "SELECT CAST(sum(Quantity) AS DOUBLE) / count(*) AS mean, quantile_cont(CAST(Quantity AS DOUBLE), 0.5) AS median, "
            "CAST(sum(Quantity) AS DOUBLE) / count(*) > quantile_cont(CAST(Quantity AS DOUBLE), 0.5) AS right_skewed FROM clean",
            "clean"),
        "holiday_quantity_counts": _sql(
            "SELECT CAST(HolidayQuantity AS DOUBLE) AS HolidayQuantity, count(*) AS lines FROM clean GROUP BY 1", "clean"),
        "histogram_quantity": _histogram("Quantity", "clean", "clean"),
        "histogram_unit_price": _histogram("UnitPrice", "clean", "clean"),
        "histogram_revenue": _histogram("Revenue", "clean", "clean"),
        "histogram_holiday_quantity": _histogram("HolidayQuantity", "clean", "clean"),
        "histogram_orders_per_customer": _histogram("TotalOrders", "kpi_raw", "kpi_raw"),
        "histogram_revenue_per_customer": _histogram(
            "Revenue", "(SELECT CustomerID, sum(Revenue) AS Revenue FROM clean GROUP BY CustomerID) AS rc", "clean"),
        "boxplot_quantity": _box("Quantity"),
        "boxplot_revenue": _box("Revenue"),
        "price_quantity_bins": _sql(
            "SELECT CAST(floor(CAST(UnitPrice AS DOUBLE) / 50.0E0) AS BIGINT) AS x_bin, "
            "CAST(floor(CAST(Quantity AS DOUBLE) / 5.0E0) AS BIGINT) AS y_bin, count(*) AS points FROM clean GROUP BY 1, 2",
            "clean"),
        "orders_revenue_bins": _sql(
            "SELECT CAST(floor(o / 1.0E0) AS BIGINT) AS x_bin, CAST(floor(r / 10000.0E0) AS BIGINT) AS y_bin, count(*) AS points "
            "FROM (SELECT count(DISTINCT InvoiceNo) AS o, CAST(sum(Revenue) AS DOUBLE) AS r FROM clean GROUP BY CustomerID) AS c "
            "GROUP BY 1, 2", "clean"),
        "null_profile": _nulls("raw", "raw", RAW.replace(",", "")),
        "null_profile_clean": _nulls(
            "clean", "clean", RAW.replace(",", "") + " Revenue Year Month_num day_of_week week CohortMonth holidayname isholiday "
            "HolidayQuantity YearMonth"),
        "duplicate_profile": _duplicates("raw", "raw", KEY, RAW),
        "holiday_duplicate_profile": _duplicates(
            "hol_raw", "hol_raw", 'date, "countryOrRegion"', 'date, "countryOrRegion", "holidayName"'),
        "describe_numeric": _describe("raw", "raw", "Quantity", "UnitPrice", "CustomerID"),
        "describe_revenue": _describe("clean", "clean", "Revenue"),
        "distinct_months": _sql("SELECT DISTINCT Month_num, YearMonth FROM clean", "clean"),
        # product features
        "lag_features": _sql(
            "SELECT StockCode, YearMonth, "
            + ", ".join(f"CAST(lag(MonthlyQuantity, {k}) {W} AS DOUBLE) AS lag{k}_quantity, "
                        f"CAST(lag(MonthlyRevenue, {k}) {W} AS DOUBLE) AS LagRevenue{k}" for k in (1, 2, 3))
            + " FROM monthly", "monthly"),
        "rolling_mean": _sql(
            f"SELECT StockCode, YearMonth, CAST(lag(MonthlyQuantity, 1) {W} + lag(MonthlyQuantity, 2) {W} "
            f"+ lag(MonthlyQuantity, 3) {W} AS DOUBLE) / 3 AS rolling_mean_3 FROM monthly", "monthly"),
        "growth_rate": _sql(
            f"SELECT StockCode, YearMonth, CAST(MonthlyQuantity AS DOUBLE) / nullif(CAST(lag(MonthlyQuantity, 1) {W} AS DOUBLE), 0) "
            "- 1 AS GrowthRate FROM monthly", "monthly"),
        "price_change": _sql(
            f"SELECT StockCode, YearMonth, AvgUnitPrice / nullif(lag(AvgUnitPrice, 1) {W}, 0) - 1 AS avg_unitprice FROM monthly",
            "monthly"),
        "monthly_features": _sql("SELECT * FROM features", "features"),
        "latest_per_product": _sql(
            "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY StockCode ORDER BY YearMonth DESC) AS rn "
            "FROM features) AS x WHERE rn = 1", "features"),
        # forecast
        "forecast_dataset": _sql("SELECT * FROM dataset", "dataset"),
        "split_sizes": _sql(
            f"SELECT CASE WHEN YearMonth <= DATE '{CUT_OFF}' THEN 'train' ELSE 'test' END AS part, count(*) AS rows "
            "FROM dataset GROUP BY 1", "dataset"),
        "scaler_stats": _sql(" UNION ALL ".join(
            f"SELECT '{f}' AS \"Feature\", round(avg(CAST({f} AS DOUBLE)), 5) AS mean, "
            f"round(stddev_pop(CAST({f} AS DOUBLE)), 5) AS std FROM train" for f in FEATURES), "train"),
        "cv_folds": _sql(
            "SELECT StockCode, YearMonth, CASE WHEN rn < n - 5 * (n // 6) THEN 0 "
            "ELSE 1 + (rn - (n - 5 * (n // 6))) // (n // 6) END AS block FROM (SELECT StockCode, YearMonth, "
            "row_number() OVER (ORDER BY YearMonth, StockCode) - 1 AS rn, count(*) OVER () AS n FROM train) AS x", "train"),
        "baseline_metrics": _sql(
            "SELECT n AS rows, ae / n AS MAE, sqrt(se / n) AS RMSE, 1 - se / (yy - y * y / n) AS R2 FROM (SELECT count(*) AS n, "
            "sum(abs(target - MonthlyQuantity)) AS ae, sum((target - MonthlyQuantity) * (target - MonthlyQuantity)) AS se, "
            "sum(target) AS y, sum(target * target) AS yy FROM test) AS x", "test"),
        "one_hot": _sql("""
            , codes AS MATERIALIZED (SELECT DISTINCT StockCode AS known_code FROM train),
            months AS MATERIALIZED (SELECT DISTINCT YearMonth AS known_month FROM train)
            SELECT StockCode, YearMonth, 'StockCode_' || StockCode AS indicator FROM test JOIN codes ON known_code = StockCode
            UNION ALL
            SELECT StockCode, YearMonth, 'YearMonth_' || strftime(YearMonth, '%Y-%m') FROM test JOIN months ON known_month = YearMonth""", "test"),
        # explanation
        "linear_attribution": _sql(
            ", m AS (SELECT " + ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m_{f}" for f in FEATURES) + " FROM train),\na AS (SELECT "
            + ", ".join(f"avg(abs({p})) AS {f}" for f, p in phi.items()) + " FROM test, m),\nl AS ("
            + " UNION ALL ".join(
                f"SELECT '{f}' AS \"Feature\", {f} AS v, CAST({w!r} AS DOUBLE) AS \"StandardizedRidgeCoefficient\" FROM a"
                for f, w in zip(FEATURES, LITERAL_WEIGHTS))
            + ")\nSELECT CAST(row_number() OVER (ORDER BY v DESC, \"Feature\") AS INTEGER) AS \"Rank\", \"Feature\", "
            "round(v, 6) AS \"MeanAbsoluteSHAP\", \"StandardizedRidgeCoefficient\" FROM l", "test"),
        "representative_error": _sql(
            "SELECT StockCode, YearMonth, target AS \"ActualNextMonthQuantity\", MonthlyQuantity AS \"PredictedNextMonthQuantity\", "
            "abs(target - MonthlyQuantity) AS \"AbsoluteError\" FROM test ORDER BY 5, StockCode, YearMonth "
            "LIMIT 1 OFFSET (SELECT count(*) // 2 FROM test)", "test"),
        # segments
        "customer_zscores": _sql(
            "SELECT CustomerID, " + ", ".join(f"round({c}, 6) AS {c}" for c in KPIS) + " FROM z", "z"),
        "assign_fixed_centroids": _sql("SELECT CustomerID, clusters FROM assigned", "assigned"),
        "churn_flag": _sql("SELECT CustomerID, Recency, CASE WHEN Recency > 180 THEN 1 ELSE 0 END AS Churn FROM kpi", "kpi"),
        "segment_labels": _sql("SELECT CustomerID, clusters, segment FROM segment", "segment"),
        "cluster_summary": _sql(f"SELECT clusters, {SUMMARY} FROM segment GROUP BY clusters", "segment"),
        "segment_sizes": _sql("SELECT segment, count(*) AS customers FROM segment GROUP BY segment", "segment"),
        "segment_profile": _sql(
            f"SELECT segment, {SUMMARY} FROM segment WHERE segment = '{segments.DORMANT}' GROUP BY segment", "segment"),
        "segment_members": _sql(
            f"SELECT CustomerID, clusters, segment, Churn FROM segment WHERE segment = '{segments.FREQUENT}' "
            "ORDER BY CustomerID LIMIT 20", "segment"),
        "customer_text": _sql("SELECT * FROM texts", "texts"),
        "silhouette_fixed": _sql(f"""
            , pair AS (SELECT x.CustomerID, x.clusters AS own, y.clusters AS other, count(*) AS n,
                sum({" + ".join(f"(x.{c} - y.{c}) * (x.{c} - y.{c})" for c in KPIS)}) AS d
              FROM assigned x, assigned y GROUP BY 1, 2, 3),
            ab AS (SELECT CustomerID, max(CASE WHEN own = other THEN n END) AS n,
                max(CASE WHEN own = other AND n > 1 THEN d / (n - 1) END) AS a,
                min(CASE WHEN own <> other THEN d / n END) AS b FROM pair GROUP BY CustomerID)
            SELECT round(avg(CASE WHEN n > 1 THEN coalesce((b - a) / nullif(greatest(a, b), 0), 0) ELSE 0 END), 6)
              AS silhouette FROM ab""", "assigned"),
        # insight texts
        "segment_text": _sql("""
            SELECT segment, concat(chr(10), 'Segment: ', segment, chr(10), 'Average Recency: ', printf('%.2f', avg(Recency)),
              chr(10), 'Average Orders: ', printf('%.2f', avg(TotalOrders)), chr(10), 'Average Frequency: ',
              printf('%.2f', avg(PurchaseFrequency)), chr(10), 'Average Order Value: ', printf('%.2f', avg(AvgOrderValue)),
              chr(10)) AS Customer_Text FROM segment GROUP BY segment""", "segment"),
        "insight_requests": _sql(
            f"SELECT CustomerID, Customer_Text, {_text(insights.PROMPT + chr(10) * 2)} || Customer_Text AS request FROM texts",
            "texts"),
        "insight_resolution": _sql(f"""
            SELECT CustomerID AS request_id, CASE CustomerID % 7
              WHEN 0 THEN 'Insight on ' || segment
              WHEN 1 THEN {_text(insights.BAD_KEY)}
              WHEN 2 THEN {_text("Error: 404 model Not Found")}
              WHEN 3 THEN {_text(insights.FALLBACK)}
              WHEN 4 THEN {_text(insights.FALLBACK)}
              WHEN 5 THEN {_text(insights.NOTHING)}
              WHEN 6 THEN 'Error: connection reset' END AS insights
            FROM segment""", "segment"),
        # questions from the business notes
        "cohort_retention": _sql(
            "SELECT CohortMonth, CAST(date_diff('month', CohortMonth, YearMonth) AS INTEGER) AS months_since, "
            "count(DISTINCT CustomerID) AS customers FROM clean GROUP BY 1, 2", "clean"),
        "purchase_rhythm": _sql("""
            SELECT CustomerID, count(DISTINCT InvoiceDate) AS purchase_days,
              CAST(date_diff('day', min(InvoiceDate), max(InvoiceDate)) AS DOUBLE) / nullif(count(DISTINCT InvoiceDate) - 1, 0)
                AS mean_gap_days, CAST(sum(Revenue) AS DOUBLE) AS lifetime_value FROM clean GROUP BY CustomerID""", "clean"),
        "revenue_concentration": _sql("""
            SELECT StockCode, CAST(r AS DOUBLE) AS revenue,
              CAST(sum(r) OVER (ORDER BY r DESC, StockCode ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(r) OVER () AS DOUBLE)
                AS cumulative_share
            FROM (SELECT StockCode, CAST(sum(Revenue) AS DECIMAL(30,5)) AS r FROM clean GROUP BY StockCode) AS x""", "clean"),
        "product_labels": _sql("""
            SELECT StockCode, CASE WHEN TotalQuantitySold >= q THEN 'Top Seller' ELSE 'Normal' END AS demand,
              CASE WHEN ActiveMonthCount <= m THEN 'High' ELSE 'Low' END AS churn,
              CASE WHEN UniqueCustomersCount >= u THEN 'High' ELSE 'Low' END AS engagement
            FROM product, (SELECT quantile_cont(TotalQuantitySold, 0.8) AS q,
              quantile_cont(CAST(ActiveMonthCount AS DOUBLE), 0.2) AS m,
              quantile_cont(CAST(UniqueCustomersCount AS DOUBLE), 0.8) AS u FROM product) AS c""", "product"),
    }
