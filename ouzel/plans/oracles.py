"""Oracle SQL for the registered queries (DuckDB dialect, same parquet tables).

Written independently of the Spark plans: plain self joins, cross joins
with offset tables and window arg-max chains, which are fine at the check
scale. Cell indexes use ``trunc`` because a DuckDB cast rounds; decimal
literals are cast to DOUBLE.
"""

from __future__ import annotations

from ouzel.functions.geometry import cell_side
from ouzel.operators.frequent import reservoir_size
from ouzel.plans import params as P

PO = ("SELECT o_orderkey AS id, "
      "datediff('day', TIMESTAMP '1995-01-01', o_orderdate)::DOUBLE / 10 AS x, "
      "o_totalprice / 1000 - 100 AS y FROM orders")
PE = (f"SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, "
      f"vec_id % {P.PE_L} AS b FROM embeddings")
EV = "SELECT event_id AS seq, CAST(floor(value) AS BIGINT) AS item FROM events"
PAR = "SELECT count(*) AS n FROM events"
PREFIX = f"(SELECT count(*) * {P.PREFIX_NUM} // {P.PREFIX_DEN} FROM events)"


def dbl(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


def dist_sql(a: str, b: str) -> str:
    return f"sqrt(({a}.x - {b}.x) * ({a}.x - {b}.x) + ({a}.y - {b}.y) * ({a}.y - {b}.y))"


def cell_sql(col: str, side: str) -> str:
    return f"trunc({col} / {side} + CASE WHEN {col} < 0 THEN -1 ELSE 0 END)::BIGINT"


def grid_ctes(pts: str, side: str, M: int) -> str:
    """CTEs cells, offs7, merged, cls over the CTE ``pts``."""
    return f"""
cells AS (SELECT i, j, count(*) AS n FROM
          (SELECT {cell_sql('x', side)} AS i, {cell_sql('y', side)} AS j FROM {pts}) GROUP BY i, j),
offs7 AS (SELECT range AS d FROM range(-3, 4)),
merged AS (SELECT c.i + a.d AS i, c.j + b.d AS j,
                  sum(CASE WHEN abs(a.d) <= 1 AND abs(b.d) <= 1 THEN c.n ELSE 0 END)::BIGINT AS n3,
                  sum(c.n)::BIGINT AS n7,
                  sum(CASE WHEN a.d = 0 AND b.d = 0 THEN c.n ELSE 0 END)::BIGINT AS n
           FROM cells c, offs7 a, offs7 b GROUP BY 1, 2),
cls AS (SELECT i, j, n, n3, n7,
               CASE WHEN n = 0 THEN 'empty' WHEN n3 > {M} THEN 'non_outlier'
                    WHEN n7 <= {M} THEN 'outlier' ELSE 'uncertain' END AS class FROM merged)"""


def po_grid(extra: str = "") -> str:
    side = dbl(cell_side(P.PO_D))
    return f"WITH po AS ({PO}),{grid_ctes('po', side, P.PO_M)}{extra}\n"


def square_sql(r: int) -> str:
    return (f"SELECT c.i + a.d AS i, c.j + b.d AS j, sum(c.n)::BIGINT AS n_sq, "
            f"sum(CASE WHEN a.d = 0 AND b.d = 0 THEN 1 ELSE 0 END)::INTEGER AS center "
            f"FROM cells c, (SELECT range AS d FROM range({-r}, {r + 1})) a, "
            f"(SELECT range AS d FROM range({-r}, {r + 1})) b GROUP BY 1, 2")


def expand_sql(r: int) -> str:
    return (f"SELECT c.i AS ci, c.j AS cj, c.i + a.d AS i, c.j + b.d AS j, c.n, "
            f"CASE WHEN a.d = 0 AND b.d = 0 THEN 1 ELSE 0 END AS center "
            f"FROM cells c, (SELECT range AS d FROM range({-r}, {r + 1})) a, "
            f"(SELECT range AS d FROM range({-r}, {r + 1})) b")


def ball_sql(pts: str, D: float) -> str:
    d = dbl(D)
    return (f"SELECT a.id, a.x, a.y, count(*) AS ball FROM {pts} a JOIN {pts} b "
            f"ON abs(a.x - b.x) < {d} AND abs(a.y - b.y) < {d} AND {dist_sql('a', 'b')} < {d} "
            f"GROUP BY a.id, a.x, a.y")


def fft_chain(src: str, K: int, part: str, prefix: str) -> tuple[list[str], str]:
    """Farthest-first as a chain of CTEs over ``src`` (id, x, y, <part>).

    Returns the CTE definitions and a query listing ``part, ord, id, x, y``.
    """
    ctes = [f"{prefix}c0 AS (SELECT {part}, id, x, y FROM (SELECT {part}, id, x, y, "
            f"row_number() OVER (PARTITION BY {part} ORDER BY id) AS rn FROM {src}) WHERE rn = 1)"]
    for t in range(1, K):
        prev_d = "" if t == 1 else f"least(p.d, "
        close = "" if t == 1 else ")"
        base = src if t == 1 else f"{prefix}d{t - 1}"
        ctes.append(f"{prefix}d{t} AS (SELECT p.{part}, p.id, p.x, p.y, "
                    f"{prev_d}{dist_sql('p', 'c')}{close} AS d "
                    f"FROM {base} p JOIN {prefix}c{t - 1} c ON p.{part} = c.{part})")
        ctes.append(f"{prefix}c{t} AS (SELECT {part}, id, x, y FROM (SELECT {part}, id, x, y, "
                    f"row_number() OVER (PARTITION BY {part} ORDER BY d DESC, id) AS rn "
                    f"FROM {prefix}d{t}) WHERE rn = 1)")
    union = " UNION ALL ".join(f"SELECT {part}, {t} AS ord, id, x, y FROM {prefix}c{t}"
                               for t in range(K))
    return ctes, union


def fft_recursive(src: str, K: int, name: str) -> str:
    """Farthest-first in every bucket of ``src`` (b, id, x, y) as a recursive CTE: a row
    for each point and round ``t``, with the center (cid, cx, cy) of its bucket in that round."""
    pick = ", ".join(f"first_value({c}) OVER (PARTITION BY b ORDER BY {{o}}) AS c{c}" for c in ("id", "x", "y"))
    d = "sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))"
    return (f"{name} AS (SELECT 0 AS t, b, id, x, y, 'infinity'::DOUBLE AS d, {pick.format(o='id')} FROM {src} UNION ALL "
            f"SELECT t + 1, b, id, x, y, d, {pick.format(o='d DESC, id')} FROM "
            f"(SELECT t, b, id, x, y, least(d, {d}) AS d FROM {name} WHERE t < {K - 1}))")


def two_round_ctes(src: str = PE, name: str = "pe") -> str:
    """CTEs ``name`` (points with bucket b), coreset (b, ord, id, x, y) and
    centers (ord, id, x, y)."""
    c1, u1 = fft_chain(name, P.PE_K, "b", "r1")
    c2, u2 = fft_chain("cs", P.PE_K, "g", "r2")
    return (f"WITH {name} AS (" + src + "),\n" + ",\n".join(c1)
            + f",\ncoreset AS ({u1}),\ncs AS (SELECT 0 AS g, id, x, y FROM coreset),\n"
            + ",\n".join(c2) + f",\ncenters AS (SELECT ord, id, x, y FROM ({u2}))")


def radius_cte(pts: str = "pe") -> str:
    return (f"rad AS (SELECT max(m) AS radius FROM (SELECT p.id, min({dist_sql('p', 'c')}) AS m "
            f"FROM {pts} p, centers c GROUP BY p.id))")


def ev_ctes() -> str:
    r = f"ln(1 / ({dbl(P.EV_DELTA)} * {dbl(P.EV_PHI)})) / {dbl(P.EV_EPSILON)}"
    draw = f"md5('{P.EV_SEED}:' || coalesce(seq::VARCHAR, ''))"
    m = reservoir_size(P.EV_PHI)
    return f"""WITH ev AS ({EV}),
par AS ({PAR}),
pre AS (SELECT seq, item FROM ev),
th AS (SELECT lpad(lower(hex(trunc({r} / n * 4503599627370496)::BIGINT)), 13, '0') AS t FROM par),
coins AS (SELECT seq, item, substr({draw}, 1, 13) AS draw, substr({draw}, 1, 13) <= (SELECT t FROM th) AS pass FROM pre),
counts AS (SELECT item, count(*) AS count FROM pre GROUP BY item),
freq AS (SELECT item, count FROM counts WHERE count >= (SELECT n FROM par) * {dbl(P.EV_PHI)}),
res AS (SELECT seq, item, {draw} AS pri FROM pre ORDER BY pri, seq NULLS FIRST, item NULLS FIRST LIMIT {m}),
entries AS (SELECT item, min(seq) AS entry FROM coins WHERE pass GROUP BY item),
sticky AS (SELECT p.item, min(e.entry) AS entry, count(*) AS count FROM pre p JOIN entries e
           ON p.item = e.item WHERE p.seq IS NULL OR p.seq >= e.entry GROUP BY p.item),
report AS (SELECT item, count FROM sticky
           WHERE count >= (SELECT n FROM par) * ({dbl(P.EV_PHI)} - {dbl(P.EV_EPSILON)})),
fr AS (SELECT item, e.count AS exact_count, s.in_sample, r.count AS sticky_count
       FROM (SELECT item, count FROM freq) e
       FULL OUTER JOIN (SELECT item, count(*) AS in_sample FROM res GROUP BY item) s USING (item)
       FULL OUTER JOIN report r USING (item))
"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    # sources
    q["points_csv_scan"] = f"SELECT x, y FROM ({PO})"
    q["points_repartition"] = (f"SELECT (vec_id % {P.PE_L})::INTEGER AS part, vec_id % {P.PE_L} AS b, count(*) AS rows "
                               f"FROM embeddings GROUP BY ALL")
    q["points_count"] = "SELECT count(*) AS n_points FROM orders"
    q["stream_items_scan"] = EV

    # grid
    q["grid_assign"] = (f"SELECT id, {cell_sql('x', dbl(cell_side(P.PO_D)))} AS i, "
                        f"{cell_sql('y', dbl(cell_side(P.PO_D)))} AS j FROM ({PO})")
    q["cell_counts"] = po_grid() + "SELECT i, j, n FROM cells"
    q["grid_expand_3"] = po_grid() + expand_sql(1)
    q["grid_expand_7"] = po_grid() + expand_sql(3)
    q["square3_counts"] = po_grid() + square_sql(1)
    q["square7_counts"] = po_grid() + square_sql(3)
    q["grid_merge"] = po_grid() + "SELECT i, j, n3, n7, n FROM merged"
    q["grid_classify"] = po_grid() + "SELECT i, j, n, n3, n7, class FROM cls"
    q["class_summary"] = (po_grid() + "SELECT class, count(*) AS cells, sum(n)::BIGINT AS points "
                          "FROM cls GROUP BY class")
    q["class_cells"] = po_grid() + "SELECT class, i, j, n FROM cls WHERE n > 0"
    q["outlier_points"] = (po_grid() + f"SELECT p.id, p.x, p.y, p.i, p.j, c.class FROM "
                           f"(SELECT id, x, y, {cell_sql('x', dbl(cell_side(P.PO_D)))} AS i, "
                           f"{cell_sql('y', dbl(cell_side(P.PO_D)))} AS j FROM po) p "
                           f"JOIN cls c ON p.i = c.i AND p.j = c.j WHERE c.n > 0")
    q["smallest_cells_topk"] = po_grid() + f"SELECT i, j, n FROM cells ORDER BY n, i, j LIMIT {P.TOP_K}"
    q["square_union"] = (po_grid() + f"SELECT 'square3' AS kind, * FROM ({square_sql(1)}) "
                         f"UNION ALL SELECT 'square7' AS kind, * FROM ({square_sql(3)}) "
                         f"UNION ALL SELECT 'cell' AS kind, i, j, n AS n_sq, 1 AS center FROM cells")

    # exact
    q["exact_outliers_theta"] = (f"WITH pe AS ({PE}) SELECT * FROM ({ball_sql('pe', P.PE_D)}) "
                                 f"WHERE ball <= {P.PE_M}")
    q["exact_outliers_grid"] = (f"WITH po AS ({PO}) SELECT * FROM ({ball_sql('po', P.PO_D)}) "
                                f"WHERE ball <= {P.PO_M}")
    q["ball_counts"] = f"WITH pe AS ({PE}) {ball_sql('pe', P.PE_D)}"
    q["exact_outliers_topk"] = (f"WITH po AS ({PO}) SELECT * FROM ({ball_sql('po', P.PO_D)}) "
                                f"WHERE ball <= {P.PO_M} ORDER BY ball, id LIMIT {P.TOP_K}")

    pec = "SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings"
    balls = (f"WITH p AS ({pec}) SELECT a.id, count(*) AS ball FROM p a JOIN p b "
             f"ON list_distance(a.v, b.v) < {dbl(P.PEC_D)} GROUP BY a.id")
    q["ball_counts_columns"] = balls
    q["exact_outliers_columns"] = f"SELECT * FROM ({balls}) WHERE ball <= {P.PEC_M}"
    q["point_distance_columns"] = (f"WITH p AS ({pec}), f AS (SELECT v AS f FROM p ORDER BY id LIMIT 1) "
                                   "SELECT id, sqrt(list_reduce(list_transform(list_zip(v, f), lambda x: (x[1] - x[2]) * (x[1] - x[2])), "
                                   "lambda x, y: x + y)) AS d FROM p, f")

    # k-center
    first = "(SELECT x, y FROM pe ORDER BY id LIMIT 1) f"
    q["point_distance"] = f"WITH pe AS ({PE}) SELECT p.id, {dist_sql('p', 'f')} AS d FROM pe p, {first}"
    q["farthest_point"] = (f"WITH pe AS ({PE}) SELECT p.id, {dist_sql('p', 'f')} AS d FROM pe p, "
                           f"{first} ORDER BY d DESC, p.id LIMIT 1")
    tr = two_round_ctes()
    q["fft_coreset"] = tr + "\nSELECT b, ord, id, x, y FROM coreset"
    q["fft_centers"] = tr + "\nSELECT ord, id, x, y FROM centers"
    q["fft_radius"] = tr + ",\n" + radius_cte() + "\nSELECT radius FROM rad"
    q["nearest_center_distance"] = (tr + f"\nSELECT p.id, min({dist_sql('p', 'c')}) AS d "
                                    f"FROM pe p, centers c GROUP BY p.id")
    q["center_cross_join"] = (tr + f"\nSELECT id, center_id, d FROM (SELECT p.id, c.id AS center_id, "
                              f"{dist_sql('p', 'c')} AS d, row_number() OVER (PARTITION BY p.id "
                              f"ORDER BY {dist_sql('p', 'c')}, c.ord) AS rn FROM pe p, centers c) "
                              f"WHERE rn = 1")
    q["pairwise_min"] = (tr + f"\nSELECT p.id, least({dist_sql('p', 'a')}, {dist_sql('p', 'b')}) AS d "
                         f"FROM pe p, (SELECT x, y FROM centers WHERE ord = 0) a, "
                         f"(SELECT x, y FROM centers WHERE ord = 1) b")
    po_b = f"SELECT id, x, y, id % {P.PE_L} AS b FROM ({PO})"
    q["fft_radius_orders"] = (two_round_ctes(po_b, "pb") + ",\n" + radius_cte("pb")
                              + "\nSELECT radius FROM rad")
    fft_side = "((SELECT radius FROM rad) / (2 * sqrt(2)))"
    q["fft_outliers"] = (tr + ",\n" + radius_cte() + "," + grid_ctes("pe", fft_side, P.PE_FFT_M)
                         + "\nSELECT class, count(*) AS cells, sum(n)::BIGINT AS points FROM cls GROUP BY class")
    ci, ui = fft_chain("pg", P.PE_K, "g", "it")
    q["fft_iterative"] = (f"WITH pe AS ({PE}), pg AS (SELECT 0 AS g, id, x, y FROM pe),\n"
                          + ",\n".join(ci) + f"\nSELECT ord, id, x, y FROM ({ui})")
    q["cluster_radius"] = (f"WITH pe AS ({PE}), pg AS (SELECT 0 AS g, id, x, y FROM pe),\n" + ",\n".join(ci)
                           + f",\ncenters AS ({ui}),\n" + radius_cte() + "\nSELECT radius FROM rad")
    q["fft_doubling"] = f"SELECT count(*) > 0 AS at_most_k, count(*) > 0 AS within FROM ({PO})"
    po_l = f"SELECT id, x, y, id % {P.ORD_L} AS b FROM ({PO})"
    q["fft_radius_orders_k100"] = (f"WITH RECURSIVE pb AS ({po_l}),\n" + fft_recursive("pb", P.ORD_K, "r1")
                                   + ",\ncs AS (SELECT 0 AS b, cid AS id, cx AS x, cy AS y FROM (SELECT DISTINCT b, t, cid, cx, cy FROM r1)),\n"
                                   + fft_recursive("cs", P.ORD_K, "r2")
                                   + ",\ncenters AS (SELECT DISTINCT t AS ord, cid AS id, cx AS x, cy AS y FROM r2),\n"
                                   + radius_cte("pb") + "\nSELECT radius FROM rad")

    # frequent items
    ev = ev_ctes()
    q["stream_prefix"] = (f"SELECT seq, item FROM (SELECT *, row_number() OVER (ORDER BY seq NULLS LAST, item NULLS LAST) AS arrival "
                          f"FROM ({EV})) WHERE arrival <= {PREFIX}")
    q["random_coin"] = ev + "SELECT seq, item, draw, pass FROM coins"
    q["item_counts"] = ev + "SELECT item, count FROM counts"
    q["frequent_exact"] = ev + "SELECT item, count FROM freq"
    q["frequent_sorted"] = ev + "SELECT item, count FROM freq ORDER BY item"
    q["exact_table_size"] = (ev + "SELECT count(*) AS items, count(*) FILTER (WHERE count >= "
                             f"(SELECT n FROM par) * {dbl(P.EV_PHI)}) AS frequent FROM counts")
    q["distinct_items"] = (ev + "SELECT count(*) AS items_total, count(DISTINCT item) AS distinct_items, "
                           "max(item) AS largest_item FROM ev")
    q["largest_item"] = ev + "SELECT max(item) AS largest_item FROM ev"
    q["reservoir_sample"] = ev + "SELECT seq, item, pri FROM res"
    q["sample_to_table"] = ev + "SELECT item, count(*) AS in_sample FROM res GROUP BY item"
    q["reservoir_distinct"] = ev + "SELECT DISTINCT item FROM res"
    q["reservoir_flagged"] = (ev + "SELECT r.item, f.item IS NOT NULL AS is_true FROM "
                              "(SELECT DISTINCT item FROM res) r LEFT JOIN freq f ON r.item = f.item")
    q["sticky_sample"] = ev + "SELECT item, entry, count FROM sticky"
    q["sticky_report"] = ev + "SELECT item, count FROM report"
    q["sticky_flagged"] = (ev + "SELECT r.item, r.count, f.item IS NOT NULL AS is_true FROM report r "
                           "LEFT JOIN freq f ON r.item = f.item")
    q["false_positives"] = (ev + "SELECT item, count FROM report r WHERE NOT EXISTS "
                            "(SELECT 1 FROM freq f WHERE f.item = r.item)")
    q["true_frequent_hit"] = (ev + "SELECT item, count FROM report r WHERE EXISTS "
                              "(SELECT 1 FROM freq f WHERE f.item = r.item)")
    q["frequent_report"] = (ev + "SELECT item, exact_count, in_sample, sticky_count, "
                            "exact_count IS NOT NULL AS is_true FROM fr")

    # streams: the batch answer of the same operator
    q["stream_item_counts"] = q["item_counts"]
    q["stream_reservoir"] = q["reservoir_sample"]
    q["stream_sticky"] = q["sticky_sample"]
    q["stream_distinct"] = q["distinct_items"]
    q["stream_frequent_report"] = q["frequent_report"]
    q["stream_line_report"] = q["frequent_report"]
    q["stream_source_report"] = q["frequent_report"]
    q["stream_counts_state"] = q["item_counts"]
    q["stream_distinct_state"] = q["distinct_items"]
    q["stream_sticky_state"] = q["sticky_sample"]
    q["stream_batch_sizes_observed"] = "SELECT count(*) AS rows, 0 AS repeated FROM events"
    q["stream_batch_sizes"] = "SELECT count(*) AS rows, 0 AS repeated FROM events"
    q["stop_after_items"] = f"SELECT {PREFIX} AS n, TRUE AS reached, 0 AS batches_after"
    return q


ORACLES = build()
