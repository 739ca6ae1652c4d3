"""SQL twins of the registered queries, for an independent engine.

Each statement derives its inputs from the provided tables by itself and uses
plain relational means (recursive CTEs for traversals, all pairs inside a
neuron for nearest nodes), so it shares nothing with the Spark plans.
"""

from __future__ import annotations

from arborspark.operators.mesh import SURFACE_SEED
from arborspark.schema import NEUROPIL_GROUPS, NEUROPIL_ORDER

ORACLES: dict[str, str] = {}

FOREST = """
forest AS (
  SELECT neuron, id, id AS row_idx, x, y, z, radius,
    CASE WHEN id = 1 THEN CAST(-1 AS BIGINT) WHEN id % 7 = 0 THEN 1 + (id*7919 + neuron*31) % (id-1) ELSE id-1 END AS parent,
    CASE WHEN id = 1 AND neuron % 4 <> 0 THEN 1 WHEN id % 7 = 3 THEN 0 WHEN id % 7 = 5 THEN 5 ELSE 6 END AS type
  FROM (SELECT l_suppkey AS neuron,
      CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_tax) AS BIGINT) AS id,
      l_quantity * CAST(1000 AS DOUBLE) AS x, l_extendedprice AS y,
      CAST(l_partkey % 997 AS DOUBLE) * CAST(100 AS DOUBLE) AS z,
      CAST(10 AS DOUBLE) + l_tax * CAST(1000 AS DOUBLE) AS radius
    FROM lineitem) t)"""

SYN = """
syn AS (
  SELECT o_custkey % (1 + (SELECT max(l_suppkey) FROM lineitem)) AS neuron, o_orderkey AS syn_id,
    CASE WHEN o_orderkey % 3 = 0 THEN 'pre' ELSE 'post' END AS syn_type,
    CAST(o_orderkey % 50 AS DOUBLE) * CAST(1000 AS DOUBLE) AS x, o_totalprice AS y,
    CAST(o_custkey % 997 AS DOUBLE) * CAST(100 AS DOUBLE) AS z
  FROM orders)"""

KIDS = """
pc AS (SELECT neuron, parent AS id, count(*) AS c FROM forest WHERE parent <> -1 GROUP BY ALL),
kids AS (SELECT f.*, coalesce(pc.c, 0) AS n_children FROM forest f LEFT JOIN pc USING (neuron, id))"""

DETAIL = """
near AS (
  SELECT s.neuron, s.syn_id, s.syn_type, f.id, f.type,
    (s.x/1000 - f.x/1000)*(s.x/1000 - f.x/1000) + (s.y/1000 - f.y/1000)*(s.y/1000 - f.y/1000) + (s.z/1000 - f.z/1000)*(s.z/1000 - f.z/1000) AS d2
  FROM syn s JOIN forest f USING (neuron)),
detail AS (
  SELECT neuron, syn_id, syn_type, m.id AS node_id, sqrt(m.d2) AS d
  FROM (SELECT neuron, syn_id, syn_type, min({'d2': d2, 'id': id}) AS m FROM near GROUP BY ALL))"""

ORDERS = """
bo AS (
  SELECT neuron, id, type, CASE WHEN type = 1 THEN 0 ELSE 1 END AS branch_order FROM kids WHERE parent = -1
  UNION ALL
  SELECT k.neuron, k.id, k.type,
    CASE WHEN b.branch_order = 0 THEN 1 ELSE b.branch_order END + CASE WHEN k.n_children >= 2 AND k.type <> 1 THEN 1 ELSE 0 END
  FROM bo b JOIN kids k ON k.neuron = b.neuron AND k.parent = b.id)"""

SCAN = """
soma AS (SELECT neuron, min_by(id, row_idx) AS soma_id, avg(x)/1000 AS sx, avg(y)/1000 AS sy, avg(z)/1000 AS sz, count(*) AS n_soma
  FROM forest WHERE type = 1 GROUP BY neuron),
scan AS (
  SELECT n.neuron, n.n_nodes, n.volume, coalesce(s.n_soma, 0) AS n_soma_nodes, s.soma_id, s.sx, s.sy, s.sz,
    CASE WHEN s.soma_id IS NOT NULL THEN (SELECT count(*) FROM forest c WHERE c.neuron = n.neuron AND c.parent = s.soma_id) END AS soma_children
  FROM (SELECT neuron, count(*) AS n_nodes, sum(greatest(radius,0)*greatest(radius,0)*greatest(radius,0)) AS volume FROM forest GROUP BY neuron) n
  LEFT JOIN soma s USING (neuron))"""

META = """
meta AS (
  SELECT s_suppkey AS root_id, CASE WHEN s_suppkey % 9 <> 0 THEN (x + CAST(s_suppkey % 7 AS DOUBLE) * 100 * 5) / 4 END AS soma_x,
    y / 4 AS soma_y, (z - CAST(s_suppkey % 7 AS DOUBLE) * 100) / 40 AS soma_z
  FROM supplier JOIN forest ON neuron = s_suppkey AND id = 1 WHERE s_suppkey % 5 <> 0)"""

STATUS = """
status AS (
  SELECT s.*, CASE WHEN n_soma_nodes = 0 THEN 'swc_no_soma' WHEN soma_x IS NULL THEN 'no_trusted_meta_soma'
      WHEN dist <= 2 THEN 'trusted_soma' ELSE 'soma_need_check' END AS soma_status,
    n_soma_nodes > 0 AND soma_x IS NOT NULL AS has_trusted_meta_soma,
    CASE WHEN n_soma_nodes > 0 THEN dist END AS soma_dist_um
  FROM (SELECT scan.*, soma_x, sqrt((soma_x/250 - sx)*(soma_x/250 - sx) + (soma_y/250 - sy)*(soma_y/250 - sy) + (soma_z/25 - sz)*(soma_z/25 - sz)) AS dist
    FROM scan LEFT JOIN (SELECT * FROM meta WHERE soma_x IS NOT NULL) m ON m.root_id = scan.neuron) s)"""

EDGE = """
edge AS (SELECT c.neuron, c.id, c.parent, c.type, c.row_idx, c.radius, p.type AS parent_type,
    sqrt(((c.x-p.x)/1000)*((c.x-p.x)/1000) + ((c.y-p.y)/1000)*((c.y-p.y)/1000) + ((c.z-p.z)/1000)*((c.z-p.z)/1000)) AS len
  FROM forest c JOIN forest p ON p.neuron = c.neuron AND p.id = c.parent)"""

SUBTREE = """
anc AS (
  SELECT neuron, id, id AS a, parent AS up FROM forest
  UNION ALL
  SELECT n.neuron, n.id, p.id, p.parent FROM anc n JOIN forest p ON p.neuron = n.neuron AND p.id = n.up)"""

BRANCHES = """
branches AS (
  SELECT anc.neuron, anc.a AS branch_id, sum(edge.len)*1000 AS cable_length, sum(greatest(edge.radius,0)^3) AS branch_volume, count(*) AS branch_nodes
  FROM anc JOIN edge ON edge.neuron = anc.neuron AND edge.id = anc.id
  WHERE (anc.neuron, anc.up) IN (SELECT neuron, soma_id FROM scan WHERE soma_id IS NOT NULL)
  GROUP BY ALL),
short AS (SELECT *, n > 1 AND longest > 0 AND cable_length < longest * 0.15 AS short
  FROM (SELECT *, max(cable_length) OVER w AS longest, count(*) OVER w AS n FROM branches WINDOW w AS (PARTITION BY neuron))),
history AS (
  SELECT *, 1 - (v - removed_volume)/v AS volume_loss,
    removed_branches > 0 AND NOT (1 - (v - removed_volume)/v > 0.10 AND NOT all_removed_are_tiny) AS accepted
  FROM (
    SELECT s.neuron, any_value(volume) AS v, max(longest) AS max_branch_length, max(n) AS before_children, count(*) FILTER (short) AS removed_branches,
      coalesce(sum(branch_nodes) FILTER (short), 0) AS removed_nodes, coalesce(sum(cable_length) FILTER (short), 0) AS removed_total_length,
      coalesce(sum(branch_volume) FILTER (short), 0) AS removed_volume,
      coalesce(max(cable_length) FILTER (short) < max(longest) * 0.05, false) AS all_removed_are_tiny
    FROM short s JOIN scan USING (neuron) GROUP BY s.neuron))"""

_NAMES = ", ".join(f"'{n}'" for n in NEUROPIL_ORDER)
REGIONS = f"""
boxes AS (
  SELECT list_extract([{_NAMES}], CAST(floor(n_nationkey / 2) * 3 + 1 AS INTEGER)) || CASE WHEN n_nationkey % 2 = 0 THEN '_L' ELSE '_R' END AS region,
    (n_nationkey % 5) * 10.0 + 0.25 AS lo_x, (n_nationkey % 5) * 10.0 + 11.25 AS hi_x,
    floor(n_nationkey / 5) * 20.0 + 0.5 AS lo_y, floor(n_nationkey / 5) * 20.0 + 21.5 AS hi_y, 0.05 AS lo_z, 70.05 AS hi_z
  FROM nation)"""

TYPED = FOREST.replace("forest AS (", "base AS (") + """,
forest AS (SELECT * REPLACE (CASE WHEN type = 1 THEN 1 ELSE 2 + (id*31 + neuron) % 3 END AS type) FROM base)"""

LABELLED = f"""{TYPED}, {KIDS}, {ORDERS}, {REGIONS},
named AS (
  SELECT f.neuron, f.id, f.type, coalesce(string_agg(region, '|' ORDER BY region), 'OUTSIDE') AS neuropil
  FROM forest f LEFT JOIN boxes ON f.x/1000 BETWEEN lo_x AND hi_x AND f.y/1000 BETWEEN lo_y AND hi_y AND f.z/1000 BETWEEN lo_z AND hi_z
  WHERE f.type IN (2, 3, 4) GROUP BY ALL),
labelled AS (SELECT n.neuron, n.type AS node_type, n.neuropil, bo.branch_order FROM named n JOIN bo USING (neuron, id)),
counts AS (SELECT neuron, node_type, neuropil, branch_order, count(*) AS node_count FROM labelled WHERE neuropil <> 'OUTSIDE' GROUP BY ALL),
fractions AS (SELECT *, node_count / sum(node_count) OVER (PARTITION BY neuron, node_type, neuropil) AS fraction FROM counts)"""


def _kept(types: str, dictionary: bool = False) -> str:
    rule = f"neuropil IN ({_NAMES})" if dictionary else "neuropil <> 'OUTSIDE' AND NOT contains(neuropil, '|')"
    return f"""
kept AS (SELECT * FROM (SELECT * REPLACE (regexp_replace(neuropil, '_(L|R)$', '') AS neuropil) FROM counts)
  WHERE node_type IN ({types}) AND branch_order BETWEEN 1 AND 60 AND {rule}),
prof AS (SELECT node_type, neuropil, branch_order, sum(node_count) AS node_count FROM kept GROUP BY ALL),
profile AS (SELECT *, node_count / sum(node_count) OVER (PARTITION BY node_type, neuropil) AS fraction FROM prof),
grid AS (
  SELECT g.node_type, g.neuropil, o.branch_order, coalesce(p.node_count, 0) AS node_count, coalesce(p.fraction, 0) AS fraction
  FROM (SELECT DISTINCT node_type, neuropil FROM profile) g CROSS JOIN (SELECT CAST(range AS INTEGER) AS branch_order FROM range(1, 61)) o
  LEFT JOIN profile p USING (node_type, neuropil, branch_order)),
facing AS (
  SELECT a.neuropil AS pre_region, b.neuropil AS post_region, a.branch_order, a.fraction AS p, b.fraction AS q
  FROM grid a JOIN grid b ON a.node_type = 2 AND b.node_type = 3 AND a.branch_order = b.branch_order
  WHERE a.neuropil IN (SELECT neuropil FROM grid WHERE node_type = 3) AND b.neuropil IN (SELECT neuropil FROM grid WHERE node_type = 2)),
js AS (
  SELECT pre_region, post_region, sum(p * branch_order) AS pre_mean_order, sum(q * branch_order) AS post_mean_order,
    greatest(sum(CASE WHEN p > 0 THEN p * log2(2*p/(p+q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2*q/(p+q)) ELSE 0 END) / 2, 0) AS js_divergence
  FROM facing GROUP BY ALL)"""


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name}"


# two-sided normal tail of z, by the positive series of the error function
_NORMAL_P = """(SELECT CASE WHEN x = 0 THEN 1 ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 500),
  lambda k: exp(2 * k * ln(2) + (2 * k + 1) * ln(x) + lgamma(k + 1) - lgamma(2 * k + 2) - x * x))) END FROM (SELECT least(abs(z) / sqrt(2), 12) AS x))"""
# two-sided tail of a correlation rho of n pairs by the t distribution, by the series of the incomplete beta function
_T_P = """(SELECT CASE WHEN y = 0 THEN 1 ELSE 1 - exp(ln(y) / 2 + a * ln(1 - y) + lgamma(a + 0.5) - lgamma(a) - lgamma(1.5))
  * list_sum(list_transform(range(0, 3000), lambda k: exp(lgamma(a + 0.5 + k) - lgamma(a + 0.5) - lgamma(1.5 + k) + lgamma(1.5) + k * ln(y)))) END
  FROM (SELECT rho * rho AS y, (n - 2) / 2 AS a))"""


def put(name: str, *ctes: str, select: str, recursive: bool = False) -> None:
    head = "WITH " + ("RECURSIVE " if recursive else "") + ",".join(ctes) + "\n" if ctes else ""
    ORACLES[name] = head + select.lstrip("\n")


def quant(values: str, key: str, probs: dict[str, float], source: str) -> str:
    """Linear-interpolation quantiles of ``values`` per key from explicit ranks."""
    pos = {n: f"round((n-1)*{p}, 9)" for n, p in probs.items()}
    picks = ", ".join(
        f"max(CASE WHEN k = floor({e}) THEN v END) + (max(CASE WHEN k = least(floor({e})+1, n-1) THEN v END) - max(CASE WHEN k = floor({e}) THEN v END)) * max({e} - floor({e})) AS {n}"
        for n, e in pos.items()
    )
    part = f"PARTITION BY {key}" if key else ""
    return f"""SELECT {key + ', ' if key else ''}{picks} FROM (
  SELECT {key + ', ' if key else ''}v, row_number() OVER ({part} ORDER BY v) - 1 AS k, count(*) OVER ({part}) AS n
  FROM (SELECT {key + ', ' if key else ''}{values} AS v FROM {source}) q0 WHERE v IS NOT NULL) q1 {'GROUP BY ' + key if key else ''}"""


# ----------------------------------------------------------- counts, retyping
put("child_counts", FOREST, KIDS, select="SELECT neuron, id, n_children FROM kids")
put("branch_degree_distribution", FOREST, KIDS, select=f"""
SELECT dataset, label AS daughter_branches, n, {r('n * 100.0 / sum(n) OVER (PARTITION BY dataset)', 'fraction_percent')}
FROM (SELECT d.dataset, l.label, count(k.id) AS n
  FROM (SELECT DISTINCT neuron % 3 AS dataset FROM forest) d CROSS JOIN (VALUES ('2'), ('3'), ('4'), ('5'), ('6+')) l(label)
  LEFT JOIN kids k ON k.neuron % 3 = d.dataset AND k.n_children >= 2 AND CASE WHEN k.n_children >= 6 THEN '6+' ELSE CAST(k.n_children AS VARCHAR) END = l.label
  GROUP BY ALL)""")
put("retype_type0", FOREST, KIDS, select="""
SELECT neuron, id, n_children, CASE WHEN type = 0 AND n_children >= 2 THEN 5 ELSE type END AS new_type, type = 0 AND n_children >= 2 AS changed FROM kids""")
put("type0_file_log", FOREST, KIDS, select="""
SELECT neuron, count(*) AS n_nodes, count(*) FILTER (type = 0) AS type0_before, count(*) FILTER (type = 5) AS type5_before,
  count(*) FILTER (type = 0 AND n_children >= 2) AS retyped_type0_to_type5,
  count(*) FILTER (type = 0 AND n_children < 2) AS type0_after,
  count(*) FILTER (type = 5 OR (type = 0 AND n_children >= 2)) AS type5_after,
  CASE WHEN bool_or(type = 0 AND n_children >= 2) THEN 'rewritten' ELSE 'unchanged' END AS output_method
FROM kids GROUP BY neuron""")
put("retype_untrusted_soma", FOREST, KIDS, select="""
SELECT neuron, id, CASE WHEN n_children >= 2 THEN 5 ELSE 0 END AS new_type FROM kids WHERE type = 1""")
put("retype_0_5", FOREST, select="""
, kept AS (SELECT * FROM forest WHERE id % 10 <> 9),
c AS (SELECT a.*, (SELECT count(*) FROM kept b WHERE b.neuron = a.neuron AND b.parent = a.id) AS n FROM kept a)
SELECT neuron, id, CASE WHEN type IN (0, 5) THEN CASE WHEN n >= 2 THEN 5 ELSE 0 END ELSE type END AS new_type,
  type IN (0, 5) AND type <> CASE WHEN n >= 2 THEN 5 ELSE 0 END AS changed FROM c""")
_RELEASE = """
ruled AS (
  SELECT *, neuron % 2 = 1 AS soma_pruned, count(*) FILTER (parent = -1) OVER (PARTITION BY neuron) AS n_roots,
    CASE WHEN neuron % 2 = 1 THEN CASE WHEN parent = -1 THEN 1 ELSE type END WHEN type = 1 THEN CASE WHEN n_children >= 2 THEN 5 ELSE 0 END ELSE type END AS t
  FROM kids),
released AS (
  SELECT *, CASE WHEN t = 0 AND n_children >= 2 THEN 5 ELSE t END AS final_type, soma_pruned AND parent = -1 AND type <> 1 AS root_to_type1,
    NOT soma_pruned AND type = 1 AS type1_removed, t = 0 AND n_children >= 2 AS type0_branch_to_type5 FROM ruled)"""
put("release_rules", FOREST, KIDS, _RELEASE, select="SELECT neuron, id, final_type, root_to_type1, type1_removed, type0_branch_to_type5 FROM released")
put("release_validation", FOREST, KIDS, _RELEASE, select="""
SELECT neuron, soma_pruned, count(*) AS n_nodes, max(n_roots) AS n_roots, count(*) FILTER (final_type = 1) AS type1_final,
  count(*) FILTER (root_to_type1) AS root_to_type1, count(*) FILTER (type1_removed) AS type1_removed,
  count(*) FILTER (type0_branch_to_type5) AS type0_branch_to_type5,
  CASE WHEN soma_pruned AND max(n_roots) <> 1 THEN 'expected 1 root, found ' || max(n_roots)
    WHEN soma_pruned AND bool_or(parent = -1 AND final_type <> 1) THEN 'root is not Type 1'
    WHEN NOT soma_pruned AND bool_or(final_type = 1) THEN 'Type 1 remains outside soma-pruned neurons'
    WHEN bool_or(final_type = 0 AND n_children >= 2) THEN 'Type-0 branch points remain' END AS error
FROM released GROUP BY neuron, soma_pruned""")
put("duplicate_node_ids", FOREST, select="""
SELECT DISTINCT neuron FROM (SELECT neuron, CASE WHEN neuron % 5 = 0 AND id % 100 = 0 THEN id - 1 ELSE id END AS i FROM forest) GROUP BY neuron, i HAVING count(*) > 1""")

# ------------------------------------------------------------------------ QC
put("type0_file_summary", FOREST, KIDS, select="""
SELECT k.neuron, count(*) AS n_nodes, count(*) FILTER (type = 0) AS type0_n,
  count(*) FILTER (type = 0 AND n_children = 0) AS type0_terminal_n, count(*) FILTER (type = 0 AND n_children = 1) AS type0_continuation_n,
  count(*) FILTER (type = 0 AND n_children = 2) AS type0_bifurcation_n, count(*) FILTER (type = 0 AND n_children >= 3) AS type0_multifurcation_n,
  count(*) FILTER (type = 0 AND n_children >= 2) AS type0_branch_n, coalesce(max(n_children) FILTER (type = 0), 0) AS type0_max_children,
  count(*) FILTER (type = 0 AND n_children >= 2) > 0 AS has_type0_branch, count(*) FILTER (type = 0 AND n_children >= 3) > 0 AS has_type0_multifurcation,
  any_value('{' || coalesce(j.d, '') || '}') AS distribution
FROM kids k LEFT JOIN (SELECT neuron, string_agg('"' || c || '":' || n, ',' ORDER BY c) AS d
  FROM (SELECT neuron, n_children AS c, count(*) AS n FROM kids WHERE type = 0 GROUP BY ALL) GROUP BY neuron) j ON j.neuron = k.neuron
GROUP BY k.neuron""")
put("type0_merged_distribution", FOREST, KIDS, select="SELECT CAST(n_children AS INTEGER) AS n_children, count(*) AS n_nodes FROM kids WHERE type = 0 GROUP BY 1")
put("type5_branch_summary", FOREST, KIDS, select="""
SELECT neuron, count(*) FILTER (type = 5) AS type5_n, count(*) FILTER (type = 5 AND n_children > 2) AS branch_gt2,
  count(*) FILTER (type = 5 AND n_children = 2) AS branch_eq2, count(*) FILTER (type = 5 AND n_children = 1) AS no_branch,
  count(*) FILTER (type = 5 AND n_children = 0) AS terminal_n, count(*) FILTER (type = 5 AND n_children = 0) > 0 AS has_terminal
FROM kids GROUP BY neuron""")
put("type6_terminal_check", FOREST, KIDS, select="""
SELECT neuron, count(*) AS n_nodes, count(*) FILTER (type = 6) AS type6_n, count(*) FILTER (type = 6 AND n_children = 0) AS type6_terminal_n,
  count(*) FILTER (type = 6 AND n_children > 0) AS type6_with_children_n, coalesce(max(n_children) FILTER (type = 6), 0) AS type6_max_children,
  count(*) FILTER (type = 6 AND n_children > 0) = 0 AS all_type6_terminal
FROM kids GROUP BY neuron""")
put("type6_violations", FOREST, KIDS, select="SELECT neuron, id AS node_id, n_children FROM kids WHERE type = 6 AND n_children > 0")
put("soma_children", FOREST, select="""
SELECT neuron, count(*) FILTER (type = 1) AS n_soma,
  count(*) FILTER ((neuron, parent) IN (SELECT neuron, id FROM forest WHERE type = 1)) AS soma_children
FROM forest GROUP BY neuron""")
put("edge_lengths", FOREST, EDGE, select=f"SELECT neuron, id, parent, {r('len', 'length_um')} FROM edge")
_SCREEN = """
par AS (SELECT neuron, parent, count(*) AS c, count(*) FILTER (len > 5) AS l FROM edge GROUP BY ALL),
screen AS (
  SELECT n.neuron, n.n_nodes, coalesce(n_valid_segments, 0) AS n_valid_segments, coalesce(n_branch_parents, 0) AS n_branch_parents,
    coalesce(n_matching_parents, 0) AS n_matching_parents, coalesce(n_matching_long_segments, 0) AS n_matching_long_segments,
    coalesce(max_long_children_same_parent, 0) AS max_long_children_same_parent, coalesce(n_matching_parents, 0) > 0 AS matched
  FROM (SELECT neuron, count(*) AS n_nodes FROM forest GROUP BY neuron) n LEFT JOIN (
    SELECT neuron, CAST(sum(c) AS BIGINT) AS n_valid_segments, count(*) FILTER (c >= 2) AS n_branch_parents, count(*) FILTER (c >= 2 AND l >= 2) AS n_matching_parents,
      CAST(sum(CASE WHEN c >= 2 AND l >= 2 THEN l ELSE 0 END) AS BIGINT) AS n_matching_long_segments, max(l) AS max_long_children_same_parent
    FROM par GROUP BY neuron) p USING (neuron))"""
put("long_child_screen", FOREST, EDGE, _SCREEN, select="SELECT * FROM screen")
put("long_child_detail", FOREST, EDGE, _SCREEN, select=f"""
SELECT e.neuron, e.parent AS parent_id, e.parent_type, p.c AS n_children, p.l AS n_long,
  string_agg(CAST(e.id AS VARCHAR), '|' ORDER BY round(len, 6) DESC, e.id) AS long_child_ids,
  string_agg(CAST(e.type AS VARCHAR), '|' ORDER BY round(len, 6) DESC, e.id) AS long_child_types,
  {r('min(len)', 'min_long_um')}, {r('avg(len)', 'mean_long_um')}, {r('max(len)', 'max_long_um')}
FROM edge e JOIN par p ON p.neuron = e.neuron AND p.parent = e.parent WHERE len > 5 AND p.c >= 2 AND p.l >= 2 GROUP BY ALL""")
put("folder_summary", FOREST, EDGE, _SCREEN, select="""
SELECT 'batch_' || (neuron % 4) AS folder, count(*) AS total_files, count(*) FILTER (matched) AS matching_files, count(*) FILTER (NOT matched) AS non_matching_files
FROM screen GROUP BY 1""")
put("volume_proxy", FOREST, SCAN, select=f"""
SELECT neuron, soma_id, n_nodes, {r('volume', 'volume', 3)}, n_soma_nodes, {r('sx', 'soma_x_um', 3)}, {r('sy', 'soma_y_um', 3)}, {r('sz', 'soma_z_um', 3)}, soma_children FROM scan""")
put("value_counts", FOREST, select="SELECT CAST(type AS VARCHAR) AS value, count(*) AS n FROM forest GROUP BY 1")
_P6 = {"p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99, "p999": 0.999}
put("describe_percentiles", FOREST, select=f"""
SELECT type, n, {r('mean', 'mean', 4)}, {r('std', 'std', 4)}, {r('lo', 'min', 4)}, {r('hi', 'max', 4)}, {', '.join(r(p, p, 4) for p in _P6)}
FROM (SELECT type, count(*) AS n, avg(radius) AS mean, stddev_samp(radius) AS std, min(radius) AS lo, max(radius) AS hi FROM forest GROUP BY type)
JOIN ({quant('radius', 'type', _P6, 'forest')}) USING (type)""")
put("soma_status", FOREST, SCAN, META, STATUS, select=f"SELECT neuron, soma_status, has_trusted_meta_soma, {r('soma_dist_um', 'soma_dist_um')} FROM status")
_P5 = {k: v for k, v in _P6.items() if k != "p75"}
put("soma_distance_stats", FOREST, SCAN, META, STATUS, select=f"""
SELECT n, {r('mean', 'mean')}, {r('std', 'std')}, {r('lo', 'min')}, {r('hi', 'max')}, {', '.join(r(p, p) for p in _P5)}
FROM (SELECT count(soma_dist_um) AS n, avg(soma_dist_um) AS mean, stddev_samp(soma_dist_um) AS std, min(soma_dist_um) AS lo, max(soma_dist_um) AS hi FROM status)
CROSS JOIN ({quant('soma_dist_um', '', _P5, 'status')})""")
put("soma_annotation_overlap", FOREST, SCAN, META, select="""
SELECT count(neuron) AS skeletons, count(*) FILTER (n_soma_nodes > 0) AS with_soma, count(*) FILTER (n_soma_nodes = 0) AS without_soma,
  count(root_id) AS listed, count(*) FILTER (n_soma_nodes > 0 AND root_id IS NOT NULL) AS with_soma_listed,
  count(*) FILTER (n_soma_nodes > 0 AND root_id IS NULL) AS with_soma_unlisted,
  count(*) FILTER (n_soma_nodes = 0 AND root_id IS NOT NULL) AS without_soma_listed, count(*) FILTER (neuron IS NULL) AS listed_without_skeleton
FROM scan FULL OUTER JOIN (SELECT DISTINCT root_id FROM meta) m ON root_id = neuron""")

# ------------------------------------------------------------- soma repair
put("soma_branch_cable", FOREST, SCAN, EDGE, SUBTREE, BRANCHES, recursive=True, select=f"""
SELECT neuron, branch_id, {r('cable_length', 'cable_length', 3)}, {r('branch_volume', 'branch_volume', 3)}, branch_nodes FROM branches""")
put("adaptive_branch_removal", FOREST, SCAN, EDGE, SUBTREE, BRANCHES, recursive=True, select="""
SELECT neuron, id FROM forest WHERE (neuron, id) NOT IN (
  SELECT anc.neuron, anc.id FROM anc JOIN short s ON s.neuron = anc.neuron AND s.branch_id = anc.a JOIN history h ON h.neuron = anc.neuron WHERE s.short AND h.accepted)""")
put("adaptive_removal_history", FOREST, SCAN, EDGE, SUBTREE, BRANCHES, recursive=True, select=f"""
SELECT neuron, {r('max_branch_length', 'max_branch_length', 4)}, before_children, removed_branches, CAST(removed_nodes AS BIGINT) AS removed_nodes,
  {r('removed_total_length', 'removed_total_length', 4)}, {r('removed_volume', 'removed_volume', 4)}, {r('volume_loss', 'volume_loss', 4)},
  all_removed_are_tiny, accepted, before_children - CASE WHEN accepted THEN removed_branches ELSE 0 END AS after_children,
  {r('CASE WHEN accepted THEN CAST(0.15 AS DOUBLE) END', 'best_threshold', 4)} FROM history""")
put("soma_repair_log", FOREST, KIDS, SCAN, META, STATUS, EDGE, SUBTREE, BRANCHES, recursive=True, select=f"""
SELECT neuron, CASE WHEN soma_status IN ('swc_no_soma', 'no_trusted_meta_soma') THEN 'no_soma' WHEN soma_status = 'soma_need_check' THEN 'soma_need_check'
    WHEN ca = 1 THEN 'unipolar' ELSE 'non_unipolar' END AS category,
  CASE soma_status WHEN 'swc_no_soma' THEN 'linked_swc_no_soma' WHEN 'no_trusted_meta_soma' THEN 'reclassified_no_trusted_meta_soma'
    WHEN 'soma_need_check' THEN 'linked_soma_need_check_no_repair'
    ELSE CASE WHEN soma_children > 1 THEN 'repaired_trusted_soma' ELSE 'linked_trusted_soma' END END AS repair_status,
  soma_status, has_trusted_meta_soma, n_soma_nodes AS n_soma_nodes_before, soma_id AS original_soma_id, {r('soma_dist_um', 'soma_dist_before', 4)},
  soma_children AS soma_children_before, ca AS soma_children_after, n_nodes AS n_nodes_before, CAST(n_nodes - gone AS BIGINT) AS n_nodes_after,
  {r('gone / n_nodes', 'node_loss', 4)}, {r('volume', 'volume_before', 4)}, {r('volume - gv', 'volume_after', 4)}, {r('gv / volume', 'volume_loss', 4)},
  {r('CASE WHEN acc THEN CAST(0.15 AS DOUBLE) END', 'best_threshold', 4)}, r0 AS reclassified_type0, r5 AS reclassified_type5, acc OR r0 + r5 > 0 AS changed
FROM (
  SELECT st.*, acc, CASE WHEN acc THEN removed_nodes ELSE 0 END AS gone, CASE WHEN acc THEN removed_volume ELSE 0 END AS gv,
    CASE WHEN soma_status = 'no_trusted_meta_soma' THEN NULL WHEN acc THEN before_children - removed_branches ELSE soma_children END AS ca,
    CASE WHEN soma_status = 'no_trusted_meta_soma' THEN (SELECT count(*) FROM kids k WHERE k.neuron = st.neuron AND type = 1 AND n_children < 2) ELSE 0 END AS r0,
    CASE WHEN soma_status = 'no_trusted_meta_soma' THEN (SELECT count(*) FROM kids k WHERE k.neuron = st.neuron AND type = 1 AND n_children >= 2) ELSE 0 END AS r5
  FROM (SELECT s.*, h.removed_nodes, h.removed_volume, h.before_children, h.removed_branches,
      coalesce(soma_status = 'trusted_soma' AND soma_children > 1 AND h.accepted, false) AS acc
    FROM status s LEFT JOIN history h USING (neuron)) st)""")

# ---------------------------------------------------------------- synapses
put("nearest_node", FOREST, SYN, DETAIL, select=f"SELECT neuron, syn_id, syn_type, node_id AS assigned_node_id, {r('d', 'distance_um')} FROM detail")
_COUNTED = """
counted AS (SELECT f.*, coalesce(pre, 0) AS pre, coalesce(post, 0) AS post FROM forest f LEFT JOIN (
  SELECT neuron, node_id AS id, count(*) FILTER (syn_type = 'pre') AS pre, count(*) FILTER (syn_type = 'post') AS post FROM detail GROUP BY ALL) USING (neuron, id))"""
put("node_synapse_counts", FOREST, SYN, DETAIL, _COUNTED, select="SELECT neuron, id, pre AS pre_syn_count, post AS post_syn_count FROM counted")
put("synapse_type", FOREST, SYN, DETAIL, _COUNTED, select="""
SELECT neuron, id, CASE WHEN type = 1 THEN 1 WHEN pre > 0 AND post > 0 THEN 4 WHEN pre > 0 THEN 2 WHEN post > 0 THEN 3 ELSE type END AS type FROM counted""")
put("synapse_type_log", FOREST, SYN, DETAIL, _COUNTED, select="""
SELECT neuron, count(*) AS n_nodes, count(*) FILTER (pre > 0 AND post = 0) AS pre_rich_nodes,
  count(*) FILTER (pre = 0 AND post > 0) AS post_rich_nodes, count(*) FILTER (pre > 0 AND post > 0) AS mixed_nodes,
  count(*) FILTER (pre > 0 OR post > 0) AS syn_nodes FROM counted GROUP BY neuron""")
_SIDE = ", ".join(f"{r(f'{s}_{f}', f'{s}_dist_{f}_um')}" for s in ("pre", "post") for f in ("mean", "median", "p95", "max"))
put("synapse_log", FOREST, SYN, DETAIL, _COUNTED, select=f"""
SELECT neuron, n_nodes, nodes_with_pre, nodes_with_post, nodes_with_both, coalesce(n_pre_syn, 0) AS n_pre_syn, coalesce(n_post_syn, 0) AS n_post_syn,
  coalesce(n_pre_syn, 0) AS assigned_pre_syn, coalesce(n_post_syn, 0) AS assigned_post_syn, coalesce(n_pre_syn, 0) > 0 AS has_pre, coalesce(n_post_syn, 0) > 0 AS has_post, {_SIDE}
FROM (SELECT neuron, count(*) AS n_nodes, count(*) FILTER (pre > 0) AS nodes_with_pre, count(*) FILTER (post > 0) AS nodes_with_post,
    count(*) FILTER (pre > 0 AND post > 0) AS nodes_with_both FROM counted GROUP BY neuron)
LEFT JOIN (SELECT neuron, count(*) FILTER (syn_type = 'pre') AS n_pre_syn, count(*) FILTER (syn_type = 'post') AS n_post_syn,
    {', '.join(f"{agg} FILTER (syn_type = '{s}') AS {s}_{f}" for s in ('pre', 'post') for f, agg in (('mean', 'avg(d)'), ('max', 'max(d)'), ('median', 'quantile_cont(d, 0.5)'), ('p95', 'quantile_cont(d, 0.95)')))}
  FROM detail GROUP BY neuron) USING (neuron)""")
_PD = {"median_um": 0.5, "p90_um": 0.9, "p95_um": 0.95, "p99_um": 0.99}
put("distance_summary", FOREST, SYN, DETAIL, select=f"""
SELECT syn_type, n, {r('a', 'mean_um')}, {r('s', 'std_um')}, {r('lo', 'min_um')}, {r('hi', 'max_um')}, {', '.join(r(p, p) for p in _PD)}
FROM (SELECT syn_type, count(*) AS n, avg(d) AS a, stddev_samp(d) AS s, min(d) AS lo, max(d) AS hi FROM detail GROUP BY syn_type) JOIN ({quant('d', 'syn_type', _PD, 'detail')}) USING (syn_type)""")
put("threshold_coverage", FOREST, SYN, DETAIL, select=f"""
SELECT syn_type, count(*) AS n, CAST(t AS DOUBLE) AS threshold_um, count(*) FILTER (d <= t) AS within_n, {r('count(*) FILTER (d <= t) * 100.0 / count(*)', 'within_percent')}, count(*) - count(*) FILTER (d <= t) AS beyond_n
FROM detail CROSS JOIN (VALUES (0.1), (0.25), (0.5), (1.0), (2.0), (5.0), (10.0)) v(t) GROUP BY ALL""")
put("distance_cdf", FOREST, SYN, DETAIL, select=f"""
, h AS (SELECT syn_type, CAST(CASE WHEN d = 10 THEN 1999 ELSE least(floor(d / (10.0/2000)::DOUBLE), 1999) END AS BIGINT) AS bin, count(*) AS n
  FROM (SELECT syn_type, round(d, 6) AS d FROM detail) WHERE d BETWEEN 0 AND 10 GROUP BY ALL)
SELECT h.syn_type, bin, {r('bin * 0.005::DOUBLE', 'bin_lo')}, n, {r('n / (sum(n) OVER (PARTITION BY h.syn_type) * 0.005::DOUBLE)', 'density')}, {r('sum(n) OVER (PARTITION BY h.syn_type ORDER BY bin) / total', 'cdf')}
FROM h JOIN (SELECT syn_type, count(*) AS total FROM detail GROUP BY 1) t ON t.syn_type = h.syn_type""")

# --------------------------------------------------------------- traversal
put("branch_order", FOREST, KIDS, ORDERS, recursive=True, select="SELECT neuron, id, branch_order FROM bo")
put("root_distance", FOREST, EDGE, """
rd AS (SELECT neuron, id, id AS root, CAST(0 AS BIGINT) AS hops, CAST(0 AS DOUBLE) AS d FROM forest WHERE parent = -1
  UNION ALL SELECT e.neuron, e.id, r.root, r.hops + 1, r.d + e.len FROM rd r JOIN edge e ON e.neuron = r.neuron AND e.parent = r.id)""",
    recursive=True, select=f"SELECT neuron, id, root, hops, {r('d', 'root_distance', 4)} FROM rd")
put("subtree_cable", FOREST, EDGE, SUBTREE, recursive=True, select=f"""
SELECT anc.neuron, anc.a AS id, {r('sum(coalesce(len, 0))', 'cable_length', 4)}, count(*) AS n_nodes
FROM anc LEFT JOIN edge ON edge.neuron = anc.neuron AND edge.id = anc.id GROUP BY 1, 2""")
_TANGLED = FOREST.replace("forest AS (", "base AS (") + """,
forest AS (SELECT * REPLACE (
    CASE WHEN id = 1 THEN -1 WHEN id % 20 = 15 AND id > 15 THEN id - 11 WHEN id % 20 = 0 AND id > 20 THEN id - 16
      WHEN id % 60 = 17 AND id > 17 THEN id - 13 ELSE id - 1 END AS parent) FROM base)"""
put("parent_first_order", _TANGLED, """
paths AS (SELECT neuron, id, [id] AS path FROM forest WHERE parent = -1
  UNION ALL SELECT f.neuron, f.id, list_append(p.path, f.id) FROM paths p JOIN forest f ON f.neuron = p.neuron AND f.parent = p.id)""",
    recursive=True, select="SELECT neuron, id, row_number() OVER (PARTITION BY neuron ORDER BY path) - 1 AS position FROM paths")
put("reroot_at_node", FOREST, """
spine AS (SELECT neuron, max(id) AS id, CAST(-1 AS BIGINT) AS tree_parent FROM forest GROUP BY neuron
  UNION ALL SELECT s.neuron, f.parent, s.id FROM spine s JOIN forest f ON f.neuron = s.neuron AND f.id = s.id WHERE f.parent <> -1)""",
    recursive=True, select="SELECT f.neuron, f.id, coalesce(s.tree_parent, f.parent) AS tree_parent FROM forest f LEFT JOIN spine s USING (neuron, id)")
for _name in ("branch_order", "root_distance", "subtree_cable", "parent_first_order"):
    ORACLES[f"{_name}_short_runs"] = ORACLES[_name]
_LOOPED = FOREST.replace("forest AS (", "base AS (") + """,
forest AS (SELECT * REPLACE (CASE WHEN neuron % 5 = 2 AND id = 1 THEN 40 WHEN neuron % 5 = 2 AND id = 90 THEN -1 WHEN neuron % 5 = 2 AND id = 130 THEN id ELSE parent END AS parent) FROM base)"""
put("looped_forest_measures", _LOOPED, EDGE, """
rd AS (SELECT neuron, id, id AS root, CAST(0 AS BIGINT) AS hops, CAST(0 AS DOUBLE) AS d FROM forest WHERE parent = -1
  UNION ALL SELECT e.neuron, e.id, r.root, r.hops + 1, r.d + e.len FROM rd r JOIN edge e ON e.neuron = r.neuron AND e.parent = r.id),
anc AS (SELECT neuron, id, id AS a FROM rd
  UNION ALL SELECT n.neuron, n.id, f.parent FROM anc n JOIN forest f ON f.neuron = n.neuron AND f.id = n.a WHERE f.parent <> -1),
below AS (SELECT anc.neuron, anc.a AS id, sum(coalesce(len, 0)) AS cable, count(*) AS n_nodes FROM anc LEFT JOIN edge ON edge.neuron = anc.neuron AND edge.id = anc.id GROUP BY 1, 2)""",
    recursive=True, select=f"""
SELECT neuron, id, root, hops, {r('d', 'root_distance', 4)}, n_nodes, {r('cable', 'cable_length', 4)}, root IS NULL AS looped FROM forest LEFT JOIN rd USING (neuron, id) LEFT JOIN below USING (neuron, id)""")
ORACLES["looped_forest_measures_short_runs"] = ORACLES["looped_forest_measures"]


def _deflection(scale: int) -> str:
    """Angles by a walk of one recursion step per hop."""
    length = lambda a, b: f"sqrt(({a}.x-{b}.x)*({a}.x-{b}.x) + ({a}.y-{b}.y)*({a}.y-{b}.y) + ({a}.z-{b}.z)*({a}.z-{b}.z))"
    move = lambda name, links: f"""
  UNION ALL SELECT w.neuron, w.sid, CASE WHEN l.nxt IS NULL OR (l.len > 0 AND w.w + l.len >= 2) THEN NULL ELSE l.nxt END,
    CASE WHEN l.nxt IS NULL THEN w.w WHEN l.len > 0 AND w.w + l.len >= 2 THEN 2 ELSE w.w + l.len END,
    {', '.join(f'CASE WHEN l.nxt IS NULL THEN w.{c} WHEN l.len > 0 AND w.w + l.len >= 2 THEN w.{c} + (l.{c} - w.{c}) * (2 - w.w) / l.len ELSE l.{c} END' for c in 'xyz')}
  FROM {name} w LEFT JOIN {links} l ON l.neuron = w.neuron AND l.id = w.cur WHERE w.cur IS NOT NULL"""  # noqa: E731
    return f"""
um AS (SELECT neuron, id, parent, n_children, x/{scale} AS x, y/{scale} AS y, z/{scale} AS z FROM kids),
ul AS MATERIALIZED (SELECT c.neuron, c.id, p.id AS nxt, p.x, p.y, p.z, {length('c', 'p')} AS len FROM um c JOIN um p ON p.neuron = c.neuron AND p.id = c.parent),
turn AS (SELECT c.neuron, m.id, c.id AS nxt, c.x, c.y, c.z, {length('c', 'm')} AS len,
    CASE WHEN coalesce({length('m', 'g')}, 0) > 0 THEN CASE WHEN {length('c', 'm')} > 0 THEN ({' + '.join(f'(m.{k}-g.{k})*(c.{k}-m.{k})' for k in 'xyz')}) / {length('m', 'g')} / {length('c', 'm')} ELSE CAST('-inf' AS DOUBLE) END ELSE 0 END AS aligned
  FROM um m JOIN um c ON c.neuron = m.neuron AND c.parent = m.id LEFT JOIN um g ON g.neuron = m.neuron AND g.id = m.parent),
dl AS MATERIALIZED (SELECT neuron, id, nxt, x, y, z, len FROM turn QUALIFY row_number() OVER (PARTITION BY neuron, id ORDER BY aligned DESC, nxt) = 1),
up(neuron, sid, cur, w, x, y, z) AS (SELECT f.neuron, f.id, f.id, CAST(0 AS DOUBLE), f.x, f.y, f.z FROM um f SEMI JOIN ul ON ul.neuron = f.neuron AND ul.id = f.id WHERE f.n_children >= 2 {move('up', 'ul')}),
arriving AS (SELECT f.neuron, f.id AS fork, f.x, f.y, f.z, f.x - u.x AS ax, f.y - u.y AS ay, f.z - u.z AS az FROM up u JOIN um f ON f.neuron = u.neuron AND f.id = u.sid WHERE u.cur IS NULL AND u.w > 0),
dn(neuron, sid, cur, w, x, y, z) AS (SELECT c.neuron, c.id, CASE WHEN l.len >= 2 THEN NULL ELSE c.id END, least(l.len, 2),
    {', '.join(f'CASE WHEN l.len >= 2 THEN a.{k} + (c.{k} - a.{k}) * 2 / l.len ELSE c.{k} END' for k in 'xyz')}
  FROM um c JOIN arriving a ON a.neuron = c.neuron AND a.fork = c.parent JOIN ul l ON l.neuron = c.neuron AND l.id = c.id {move('dn', 'dl')}),
leaving AS (SELECT d.neuron, d.sid AS child, a.ax, a.ay, a.az, d.x - a.x AS dx, d.y - a.y AS dy, d.z - a.z AS dz
  FROM dn d JOIN um c ON c.neuron = d.neuron AND c.id = d.sid JOIN arriving a ON a.neuron = d.neuron AND a.fork = c.parent WHERE d.cur IS NULL AND d.w > 0),
angles AS (SELECT neuron, child, degrees(acos(greatest(least((ax*dx + ay*dy + az*dz) / sqrt(ax*ax + ay*ay + az*az) / sqrt(dx*dx + dy*dy + dz*dz), 1), -1))) AS angle_deg
  FROM leaving WHERE ax*ax + ay*ay + az*az > 0 AND dx*dx + dy*dy + dz*dz > 0)"""


put("deflection_angle", FOREST, KIDS, _deflection(1000), recursive=True, select=f"SELECT neuron, child, {r('angle_deg', 'angle_deg', 4)} FROM angles")
put("deflection_close_up", FOREST, KIDS, _deflection(100_000), recursive=True, select=f"SELECT neuron, child, {r('angle_deg', 'angle_deg', 4)} FROM angles")
ORACLES["deflection_close_up_short_runs"] = ORACLES["deflection_close_up"]
_FEATURE = """
counted AS (SELECT neuron, count(*) FILTER (n_children >= 2) AS n_branch_points, count(*) FILTER (n_children = 2) AS degree_2, count(*) FILTER (n_children = 3) AS degree_3,
    count(*) FILTER (n_children = 4) AS degree_4, count(*) FILTER (n_children = 5) AS degree_5, count(*) FILTER (n_children >= 6) AS degree_ge6 FROM kids GROUP BY neuron),
feature AS (SELECT c.*, coalesce(n, 0) AS n_deflection_angles, mean AS mean_deflection_angle_deg, median AS median_deflection_angle_deg
  FROM counted c LEFT JOIN (SELECT neuron, count(*) AS n, avg(angle_deg) AS mean, quantile_cont(angle_deg, 0.5) AS median FROM angles GROUP BY neuron) USING (neuron))"""
put("deflection_features", FOREST, KIDS, _deflection(1000), _FEATURE, recursive=True, select=f"""
SELECT * REPLACE (round(mean_deflection_angle_deg, 4) + 0.0 AS mean_deflection_angle_deg, round(median_deflection_angle_deg, 4) + 0.0 AS median_deflection_angle_deg) FROM feature""")
put("deflection_summary", FOREST, KIDS, _deflection(1000), _FEATURE, recursive=True, select=f"""
SELECT neuron % 3 AS dataset, count(*) AS n_neurons, CAST(sum(n_branch_points) AS BIGINT) AS n_branch_points, CAST(sum(n_deflection_angles) AS BIGINT) AS n_angles,
  {r('avg(mean_deflection_angle_deg)', 'mean_neuron_angle', 4)}, {r('quantile_cont(mean_deflection_angle_deg, 0.5)', 'median_neuron_angle', 4)} FROM feature GROUP BY 1""")
_PROX = """
small AS (SELECT * REPLACE (x/20 AS x, y/20 AS y, z/20 AS z) FROM kids),
rd AS (SELECT neuron, id, CAST(0 AS FLOAT) AS d FROM small WHERE parent = -1 AND type = 1
  UNION ALL SELECT c.neuron, c.id, r.d + CAST(sqrt(((c.x-p.x)/1000)^2 + ((c.y-p.y)/1000)^2 + ((c.z-p.z)/1000)^2) AS FLOAT)
  FROM rd r JOIN small p ON p.neuron = r.neuron AND p.id = r.id JOIN small c ON c.neuron = p.neuron AND c.parent = p.id WHERE r.d <= 10),
prox AS (
  SELECT n.neuron, n_type1, n_root_type1, CASE WHEN n_root_type1 > 0 THEN coalesce(a, 0) END AS n_branch_points_10um, CASE WHEN n_root_type1 > 0 THEN coalesce(b, 0) END AS soma_branch_count_10um
  FROM (SELECT neuron, count(*) FILTER (type = 1) AS n_type1, count(*) FILTER (type = 1 AND parent < 0) AS n_root_type1 FROM small GROUP BY neuron) n
  LEFT JOIN (SELECT neuron, count(*) AS a, CAST(sum(n_children - 1) AS BIGINT) AS b FROM rd JOIN small USING (neuron, id) WHERE d <= 10 AND n_children >= 2 AND type <> 1 GROUP BY neuron) USING (neuron))"""
put("soma_proximal_branches", FOREST, KIDS, _PROX, recursive=True, select="SELECT * FROM prox")
_PS = {"median": 0.5, "q25": 0.25, "q75": 0.75}
put("soma_proximal_summary", FOREST, KIDS, _PROX, recursive=True, select=f"""
SELECT dataset, n, {r('m', 'mean')}, {r('s', 'std')}, {', '.join(r(p, p) for p in _PS)}
FROM (SELECT neuron % 3 AS dataset, count(*) AS n, avg(soma_branch_count_10um) AS m, stddev_samp(soma_branch_count_10um) AS s FROM prox WHERE soma_branch_count_10um IS NOT NULL GROUP BY 1)
JOIN ({quant('soma_branch_count_10um', 'dataset', _PS, '(SELECT neuron % 3 AS dataset, * FROM prox) p0')}) USING (dataset)""")
put("soma_branch_histogram", FOREST, KIDS, _PROX, recursive=True, select=f"""
SELECT neuron % 3 AS dataset, least(soma_branch_count_10um, 4) AS value, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY neuron % 3)', 'percent')}
FROM prox WHERE soma_branch_count_10um IS NOT NULL GROUP BY 1, 2""")

# ---------------------------------------------------------------- neuropils
put("neuropil_box", LABELLED, recursive=True, select="""
SELECT neuron, count(*) AS n_target_nodes, count(*) FILTER (neuropil = 'OUTSIDE') AS n_outside, count(*) FILTER (contains(neuropil, '|')) AS n_multi FROM labelled GROUP BY neuron""")
put("neuropil_order_counts", LABELLED, recursive=True, select="SELECT * FROM counts")
put("order_fraction", LABELLED, recursive=True, select=f"SELECT neuron, node_type, neuropil, branch_order, node_count, {r('fraction', 'fraction')} FROM fractions")
put("pooled_distribution", LABELLED, recursive=True, select=f"""
SELECT *, {r('node_count / sum(node_count) OVER (PARTITION BY node_type, neuropil)', 'node_fraction')}
FROM (SELECT node_type, neuropil, branch_order, CAST(sum(node_count) AS BIGINT) AS node_count, count(DISTINCT neuron) AS n_neurons FROM counts GROUP BY ALL)""")
put("zero_filled_stats", LABELLED, recursive=True, select=f"""
, dense AS (
  SELECT g.node_type, g.neuropil, o.branch_order, g.neuron, coalesce(f.fraction, 0) AS v
  FROM (SELECT DISTINCT node_type, neuropil, neuron FROM fractions) g JOIN (SELECT DISTINCT node_type, neuropil, branch_order FROM fractions) o USING (node_type, neuropil)
  LEFT JOIN fractions f USING (node_type, neuropil, neuron, branch_order))
SELECT node_type, neuropil, branch_order, count(*) AS n_neurons, {r('avg(v)', 'mean_fraction')}, {r('quantile_cont(v, 0.5)', 'median_fraction')},
  {r('CASE WHEN count(*) > 1 THEN stddev_samp(v) ELSE 0 END', 'std_fraction')}, {r('CASE WHEN count(*) > 1 THEN stddev_samp(v) / sqrt(count(*)) ELSE 0 END', 'sem_fraction')}
FROM dense GROUP BY ALL""")
put("order_profile", LABELLED, _kept("2, 3, 4"), recursive=True, select=f"SELECT node_type, neuropil, branch_order, CAST(node_count AS BIGINT) AS node_count, {r('fraction', 'fraction')} FROM grid")
put("minmax_profile", LABELLED, _kept("2, 3, 4"), recursive=True, select=f"""
SELECT node_type, neuropil, branch_order, CAST(node_count AS BIGINT) AS node_count, {r('fraction', 'fraction')},
  {r('(fraction - min(fraction) OVER w) / CASE WHEN max(fraction) OVER w > min(fraction) OVER w THEN max(fraction) OVER w - min(fraction) OVER w ELSE 1 END', 'scaled')}
FROM grid WINDOW w AS (PARTITION BY node_type, neuropil)""")
_GROUP_CASE = "CASE " + " ".join(f"WHEN pre_region IN ({', '.join(repr(n) for n in names)}) THEN '{g}'" for g, names in NEUROPIL_GROUPS) + " END"
put("mean_order_delta", LABELLED, _kept("2, 3", True), recursive=True, select=f"""
SELECT pre_region AS neuropil, {r('pre_mean_order', 'pre_mean_order')}, {r('post_mean_order', 'post_mean_order')}, {r('js_divergence', 'js_divergence')},
  {_GROUP_CASE} AS region_group, {r('post_mean_order - pre_mean_order', 'delta_post_minus_pre')} FROM js WHERE pre_region = post_region""")
put("js_similarity_pairs", LABELLED, _kept("2, 3"), recursive=True, select=f"""
SELECT pre_region, post_region, pre_region = post_region AS same_region, {r('1 - sqrt(js_divergence)', 'similarity')} FROM js""")
_FS = """
fs AS (SELECT neuron, count(*) AS t, count(*) FILTER (neuropil = 'OUTSIDE') AS o FROM labelled GROUP BY neuron)"""
put("outside_summary", LABELLED, _FS, recursive=True, select=f"""
SELECT count(*) AS n_neurons, count(*) FILTER (o > 0) AS with_outside, {r('avg(o)', 'mean_outside')}, {r('avg(o / t)', 'mean_outside_fraction')},
  {r('quantile_cont(o, 0.5)', 'median_outside')}, {r('quantile_cont(o / t, 0.5)', 'median_outside_fraction')} FROM fs""")
put("outside_top_share", LABELLED, _FS, recursive=True, select=f"""
, s AS (SELECT o, row_number() OVER (ORDER BY o DESC, neuron) AS k, sum(o) OVER (ORDER BY o DESC, neuron) AS cs, count(*) OVER () AS n, sum(o) OVER () AS total FROM fs WHERE o > 0)
SELECT CAST(p AS DOUBLE) AS top_share, k, {r('cs / total', 'share')} FROM s JOIN (VALUES (0.01), (0.05), (0.1), (0.2), (0.5)) v(p) ON k = greatest(1, CAST(ceil(round(n * p, 9)) AS BIGINT))""")
_DO = """
per_node AS (SELECT neuron, node_id AS id, CASE WHEN count(*) FILTER (syn_type = 'pre') > 0 THEN 2 ELSE 3 END AS node_type, round(quantile_cont(d, 0.5), 5) AS x
  FROM detail GROUP BY ALL HAVING (count(*) FILTER (syn_type = 'pre') = 0) <> (count(*) FILTER (syn_type = 'post') = 0)),
dor AS (SELECT p.*, b.branch_order AS y FROM per_node p JOIN bo b USING (neuron, id) WHERE p.neuron IN (SELECT neuron FROM forest WHERE type = 1))"""
put("qcut_distance_order", FOREST, SYN, KIDS, ORDERS, DETAIL, _DO, recursive=True, select=f"""
, ranked AS (SELECT node_type, x, row_number() OVER (PARTITION BY node_type ORDER BY x) - 1 AS k, count(*) OVER (PARTITION BY node_type) AS n FROM dor),
edges AS (
  SELECT DISTINCT e.node_type, a.x + (b.x - a.x) * (((e.n - 1) * e.i) % 20) / 20.0 AS edge
  FROM (SELECT DISTINCT node_type, n, range AS i FROM ranked CROSS JOIN range(0, 21)) e
  JOIN ranked a ON a.node_type = e.node_type AND a.k = ((e.n - 1) * e.i) // 20
  JOIN ranked b ON b.node_type = e.node_type AND b.k = least(((e.n - 1) * e.i) // 20 + 1, e.n - 1)),
placed AS (SELECT d.node_type, d.x, d.y, greatest((SELECT count(*) FROM edges e WHERE e.node_type = d.node_type AND e.edge < d.x), 1) AS bin FROM dor d)
SELECT node_type, CAST(bin AS INTEGER) AS bin, count(*) AS n, {r('quantile_cont(x, 0.5)', 'median_x')}, {r('quantile_cont(y, 0.5)', 'median_y')}, {r('quantile_cont(y, 0.25)', 'q25_y')}, {r('quantile_cont(y, 0.75)', 'q75_y')}
FROM placed GROUP BY node_type, bin""")
put("spearman", FOREST, SYN, KIDS, ORDERS, DETAIL, _DO, recursive=True, select=f"""
, rho AS (SELECT node_type, count(*) AS n, corr(rx, ry) AS rho FROM (
  SELECT node_type, rank() OVER (PARTITION BY node_type ORDER BY x) + (count(*) OVER (PARTITION BY node_type, x) - 1) / 2 AS rx,
    rank() OVER (PARTITION BY node_type ORDER BY y) + (count(*) OVER (PARTITION BY node_type, y) - 1) / 2 AS ry FROM dor) GROUP BY node_type)
SELECT node_type, n, {r('rho', 'rho')}, {r(_T_P, 'p_value')} FROM rho""")

# --------------------------------------------------------------- statistics
_FEATURES = """
feat AS (
  SELECT n.neuron, coalesce(a, 0) AS raw, coalesce(b, 0) AS repaired, coalesce(a, 0) - n.neuron % 13 AS other
  FROM (SELECT DISTINCT neuron FROM forest) n
  LEFT JOIN (SELECT neuron, count(*) AS a FROM kids WHERE n_children >= 2 GROUP BY 1) USING (neuron)
  LEFT JOIN (SELECT neuron, count(*) AS b FROM (SELECT p.neuron, p.id FROM forest p JOIN forest c ON c.neuron = p.neuron AND c.parent = p.id
      WHERE p.id % 11 <> 10 AND c.id % 11 <> 10 GROUP BY ALL HAVING count(*) >= 2) GROUP BY 1) USING (neuron))"""
_MWU = """
u AS (SELECT count(*) FILTER (g = 1) AS n1, count(*) FILTER (g = 2) AS n2, sum(rk) FILTER (g = 1) - count(*) FILTER (g = 1) * (count(*) FILTER (g = 1) + 1) / 2 AS u FROM ranked),
ties AS (SELECT sum(c ** 3 - c) AS t FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM ranked GROUP BY rk)),
z AS (SELECT *, greatest(greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5, 0) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - t / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u, ties)"""
put("avg_rank_mwu", FOREST, KIDS, _FEATURES, select=f"""
, long AS (SELECT raw AS v, 1 AS g FROM feat UNION ALL SELECT other, 2 FROM feat),
ranked AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS rk FROM long),{_MWU}
SELECT n1, n2, {r('u', 'u')}, {r('2 * u / (n1 * n2) - 1', 'rank_biserial')}, {r(_NORMAL_P, 'p_value')} FROM z""")
_SIGNED = """
w AS (SELECT d, rank() OVER (ORDER BY abs(d)) + (count(*) OVER (PARTITION BY abs(d)) - 1) / 2 AS rk FROM d WHERE d <> 0),
s AS (SELECT count(*) AS n, coalesce(sum(rk) FILTER (d > 0), 0) AS wp, coalesce(sum(rk) FILTER (d < 0), 0) AS wm, (SELECT count(*) FROM d) AS n_pairs FROM w),
ties AS (SELECT coalesce(sum(c ** 3 - c), 0) AS t FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM w GROUP BY rk)),
z AS (SELECT *, abs(least(wp, wm) - n * (n + 1) / 4) / sqrt(n * (n + 1) * (2 * n + 1) / 24 - t / 48) AS z FROM s, ties),
ways(step, total, w) AS (SELECT 0, 0, CAST(1 AS DOUBLE)
  UNION ALL SELECT step + 1, total + a * (step + 1), sum(w) FROM ways, (VALUES (0), (1)) v(a), s WHERE step < n AND n <= 50 GROUP BY 1, 2),
exact AS (SELECT coalesce(sum(w), 0) / 2.0 ** (SELECT n FROM s) AS half FROM ways WHERE step = (SELECT n FROM s) AND total <= (SELECT least(wp, wm) FROM s))"""
_SIGNED_P = f"CASE WHEN n = 0 THEN 1 WHEN n <= 50 AND t = 0 AND n = n_pairs THEN least(1, 2 * (SELECT half FROM exact)) ELSE {_NORMAL_P} END"
put("signed_rank_w", FOREST, KIDS, _FEATURES, recursive=True, select=f"""
, d AS (SELECT repaired - raw AS d FROM feat),{_SIGNED}
SELECT n_pairs, n, {r('CAST(wp AS DOUBLE)', 'w_plus')}, {r('CAST(wm AS DOUBLE)', 'w_minus')}, {r('CAST(least(wp, wm) AS DOUBLE)', 'w')},
  {r('CASE WHEN wp + wm > 0 THEN (wp - wm) / (wp + wm) ELSE 0 END', 'rank_biserial')}, {r(_SIGNED_P, 'p_value')} FROM z""")
_ADJUSTED = "least(p_value * 3, 1)"
put("rank_test_p_values", FOREST, KIDS, _FEATURES, recursive=True, select=f"""
, d AS (SELECT other - raw AS d FROM feat),{_SIGNED},
signed AS (SELECT 'signed_rank' AS test, CASE WHEN wp + wm > 0 THEN (wp - wm) / (wp + wm) ELSE 0 END AS rank_biserial, {_SIGNED_P} AS p_value FROM z),
long AS (SELECT raw AS v, 1 AS g FROM feat UNION ALL SELECT other, 2 FROM feat),
ranked AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS rk FROM long),
{_MWU.replace('ties AS', 'ties2 AS').replace('z AS (', 'z2 AS (').replace('FROM u, ties)', 'FROM u, ties2)')},
tests AS (SELECT * FROM signed UNION ALL SELECT 'rank_sum', 2 * u / (n1 * n2) - 1, {_NORMAL_P} FROM z2)
SELECT test, {r('rank_biserial', 'rank_biserial')}, {r('p_value', 'p_value')}, {r(_ADJUSTED, 'p_adjusted')},
  CASE WHEN {_ADJUSTED} < 0.001 THEN '***' WHEN {_ADJUSTED} < 0.01 THEN '**' WHEN {_ADJUSTED} < 0.05 THEN '*' ELSE 'ns' END AS mark FROM tests""")
_DELTA = """
delta AS (SELECT pre_region AS name, post_mean_order - pre_mean_order AS d FROM js WHERE pre_region = post_region)"""
_FLIPS = """
flips AS (SELECT draw, round(avg(CASE WHEN md5('0:' || draw || ':' || name) < '8' THEN d ELSE -d END), 9) AS null_mean, round(avg(d), 9) AS seen FROM delta, range(10000) t(draw) GROUP BY draw),
flip AS (SELECT (SELECT count(*) FROM delta) AS n, (SELECT avg(d) FROM delta) AS mean_delta, (count(*) FILTER (abs(null_mean) >= abs(seen)) + 1) / 10001 AS p FROM flips)"""
put("sign_permutation_p", LABELLED, _kept("2, 3", True), _DELTA, _FLIPS, recursive=True, select=f"""
SELECT n, {r('mean_delta', 'mean_delta')}, {r('p', 'permutation_p')} FROM flip""")
put("pooled_asymmetry", LABELLED, _kept("2, 3", True), _DELTA, _FLIPS, recursive=True, select=f"""
, d AS (SELECT d FROM delta),{_SIGNED}
SELECT flip.n, {r('mean_delta', 'mean_delta')}, {r('p', 'permutation_p')}, {r('CAST(least(wp, wm) AS DOUBLE)', 'wilcoxon_w')},
  {r(_SIGNED_P.replace('n = 0', 'z.n = 0').replace('WHEN n <= 50', 'WHEN z.n <= 50').replace('n = n_pairs', 'z.n = n_pairs'), 'wilcoxon_p')} FROM z, flip""")
_SIMILAR = """
sim AS (SELECT pre_region, post_region, 1 - sqrt(js_divergence) AS similarity FROM js)"""
put("label_permutation_p", LABELLED, _kept("2, 3"), _SIMILAR, recursive=True, select=f"""
, names AS (SELECT pre_region AS name FROM sim WHERE pre_region = post_region),
dealt AS (SELECT draw, name, row_number() OVER (PARTITION BY draw ORDER BY name) AS a, row_number() OVER (PARTITION BY draw ORDER BY md5('42:' || draw || ':' || name)) AS b FROM names, range(10000) t(draw)),
seen AS (SELECT avg(similarity) AS same FROM sim WHERE pre_region = post_region),
shuffled AS (SELECT x.draw, avg(similarity) AS v FROM dealt x JOIN dealt y ON x.draw = y.draw AND x.a = y.b JOIN sim ON pre_region = x.name AND post_region = y.name GROUP BY x.draw)
SELECT (SELECT count(*) FROM names) AS n_regions, {r('max(same)', 'mean_same')}, {r('(count(*) FILTER (round(v, 9) >= round(same, 9)) + 1) / 10001', 'permutation_p')} FROM shuffled, seen""")
put("same_or_different_regions", LABELLED, _kept("2, 3"), _SIMILAR, recursive=True, select=f"""
, long AS (SELECT round(similarity, 9) AS v, CASE WHEN pre_region = post_region THEN 1 ELSE 2 END AS g FROM sim),
ranked AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2 AS rk FROM long),{_MWU}
SELECT n1, n2, {r('u', 'u')}, {r('2 * u / (n1 * n2) - 1', 'rank_biserial')}, {r(_NORMAL_P, 'p_value')},
  {', '.join(r(f'(SELECT {f} FROM long WHERE g = {g})', f'{side}_{name}') for g, side in ((1, 'same'), (2, 'different')) for f, name in (('quantile_cont(v, 0.5)', 'median'), ('avg(v)', 'mean')))} FROM z""")
put("change_summary", FOREST, KIDS, _FEATURES, select=f"""
SELECT count(*) AS n, {r('avg(abs(repaired - raw))', 'mean_abs_change')}, count(*) FILTER (repaired > raw) AS rises, count(*) FILTER (repaired < raw) AS falls,
  {r('quantile_cont(abs(repaired - raw), 0.5)', 'median_abs_change')} FROM feat""")

# --------------------------------------------------------------------- logs
put("keep_last", select="SELECT o_custkey % 500 AS file, max(o_orderkey) AS seq, max_by(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1")
put("set_ops", select="""
SELECT id, 'both' AS kind FROM (SELECT c_custkey AS id FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT id, 'left_only' FROM (SELECT c_custkey AS id FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT id, 'right_only' FROM (SELECT o_custkey AS id FROM orders EXCEPT SELECT c_custkey FROM customer)""")
put("resume_anti", select="""
SELECT DISTINCT l_suppkey AS file FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)""")
put("operation_rates", select=f"""
SELECT CASE WHEN s_nationkey % 6 <> 0 THEN 'class_' || (s_nationkey % 6) ELSE 'Unknown' END AS classify, count(*) AS files,
  {r('avg(CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) * 100', 'remove_soma_branches_automatically')}, {r('avg(CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END) * 100', 'prun_soma_region')},
  {r('avg(CASE WHEN s_acctbal > 3000 THEN 1 ELSE 0 END) * 100', '"Multifurcation_Binarization"')}, {r('avg(CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END) * 100', '"Assign_synapse"')}
FROM supplier GROUP BY 1""")

# ------------------------------------------------------------- surface meshes
_SAMPLES = """
smp AS (
  SELECT e.neuron, e.id AS child_id, e.parent AS parent_id, k, p.x + (k+0.5)/n*(e.x-p.x) AS sx, p.y + (k+0.5)/n*(e.y-p.y) AS sy, p.z + (k+0.5)/n*(e.z-p.z) AS sz,
    p.radius + (k+0.5)/n*(e.radius-p.radius) AS radius, len/n AS weight, len AS length_nm, e.type = 1 OR p.type = 1 AS soma_edge
  FROM (SELECT f.*, len*1000 AS len, least(4, greatest(1, CAST(ceil(len/20) AS INTEGER))) AS n FROM forest f JOIN edge USING (neuron, id)) e
  JOIN forest p ON p.neuron = e.neuron AND p.id = e.parent, LATERAL (SELECT CAST(range AS INTEGER) AS k FROM range(0, e.n)) WHERE len > 0)"""
_NBOX = """
nbox AS (SELECT neuron, min(x) AS lo_x, max(x) AS hi_x, min(y) AS lo_y, max(y) AS hi_y, min(z) AS lo_z, max(z) AS hi_z FROM forest GROUP BY neuron)"""
put("edge_samples", FOREST, EDGE, _SAMPLES, select=f"""
SELECT neuron, child_id, parent_id, k, {r('sx', 'sx')}, {r('sy', 'sy')}, {r('sz', 'sz')}, {r('radius', 'radius')}, {r('weight', 'weight')}, {r('length_nm', 'length_nm')}, soma_edge FROM smp""")


def wquant(value: str, source: str, probs: dict[str, float], tie: str = "child_id, k", key: str = "neuron") -> str:
    def one(p: float) -> str:
        a, b = f"max({{'c': c, 'v': v}}) FILTER (c <= {p})", f"min({{'c': c, 'v': v}}) FILTER (c > {p})"
        return f"CASE WHEN ({a}) IS NULL THEN (min({{'c': c, 'v': v}})).v WHEN ({b}) IS NULL THEN (max({{'c': c, 'v': v}})).v ELSE ({a}).v + (({b}).v - ({a}).v) * ({p} - ({a}).c) / (({b}).c - ({a}).c) END"
    return f"""SELECT {key}, {', '.join(f'{one(p)} AS {n}' for n, p in probs.items())} FROM (
  SELECT {key}, {value} AS v, (sum(weight) OVER (PARTITION BY {key} ORDER BY {value}, {tie}) - weight/2) / sum(weight) OVER (PARTITION BY {key}) AS c FROM {source}) w GROUP BY {key}"""


_WQ = {"q50": 0.5, "q90": 0.9, "q95": 0.95}
put("weighted_quantile", FOREST, EDGE, _SAMPLES, select=f"SELECT neuron, {', '.join(r(n, n, 3) for n in _WQ)} FROM ({wquant('radius', 'smp', _WQ)})")
_CENTER = """
center AS (
  SELECT s.*, d AS center_dist, abs(d - radius) AS error, greatest(d - radius, 0) AS excess FROM (
    SELECT smp.*, least(sx-lo_x, hi_x-sx, sy-lo_y, hi_y-sy, sz-lo_z, hi_z-sz) AS d FROM smp JOIN nbox USING (neuron)) s)"""
put("mesh_center_distance", FOREST, EDGE, _SAMPLES, _NBOX, _CENTER, select=f"SELECT neuron, child_id, k, {r('center_dist', 'center_dist')} FROM center")
_BACK = """
lattice AS (
  SELECT neuron, i AS point_id,
    CASE WHEN i // 32 = 0 THEN CASE WHEN (i // 16) % 2 = 0 THEN lo_x ELSE hi_x END ELSE lo_x + a*(hi_x-lo_x) END AS px,
    CASE WHEN i // 32 = 1 THEN CASE WHEN (i // 16) % 2 = 0 THEN lo_y ELSE hi_y END WHEN i // 32 = 0 THEN lo_y + a*(hi_y-lo_y) ELSE lo_y + b*(hi_y-lo_y) END AS py,
    CASE WHEN i // 32 = 2 THEN CASE WHEN (i // 16) % 2 = 0 THEN lo_z ELSE hi_z END ELSE lo_z + b*(hi_z-lo_z) END AS pz
  FROM (SELECT nbox.*, range AS i, ((range // 4) % 4 + 0.5)/4 AS a, (range % 4 + 0.5)/4 AS b FROM nbox CROSS JOIN range(0, 96))),
back AS (
  SELECT neuron, point_id, m.child_id AS child_id, abs(sqrt(m.d2) - m.radius) AS error, greatest(sqrt(m.d2) - m.radius, 0) AS excess FROM (
    SELECT l.neuron, l.point_id, min({'d2': (px-sx)*(px-sx) + (py-sy)*(py-sy) + (pz-sz)*(pz-sz), 'child_id': child_id, 'k': k, 'radius': radius}) AS m
    FROM lattice l JOIN smp USING (neuron) GROUP BY ALL))"""
_TH = (2000, 5000, 10000)
_CE = {f"e{p}": p / 100 for p in (50, 90, 95)}
_F1 = lambda t: f"CASE WHEN cf{t} + sf{t} > 0 THEN 2*cf{t}*sf{t}/(cf{t}+sf{t}) ELSE 0 END"
put("mesh_agreement", FOREST, EDGE, _SAMPLES, _NBOX, _CENTER, _BACK, select=f"""
SELECT neuron, n_nodes, n_edges, {r('cable', 'cable_length_um', 3)}, n_center_samples, n_surface_samples, {r('CAST(1 AS DOUBLE)', 'center_in_mesh_aabb_fraction', 3)},
  {', '.join(r(f'e{p}', f'center_shell_error_p{p}_nm', 3) for p in (50, 90, 95))}, {r('d50', 'center_to_surface_p50_nm', 3)}, {r('x90', 'center_excess_p90_nm', 3)},
  {', '.join(r(f's{p}', f'surface_shell_error_p{p}_nm', 3) for p in (50, 90, 95))}, {r('sx90', 'surface_excess_p90_nm', 3)},
  'all' AS scope, 'triangle' AS center_distance_method,
  {', '.join(f"{r(f'cf{t}', f'cable_fit_fraction_{t}nm', 3)}, {r(f'sf{t}', f'surface_fit_fraction_{t}nm', 3)}, {r(_F1(t), f'bidirectional_f1_{t}nm', 3)}, {r('100 * ' + _F1(t), f'match_score_{t}nm', 3)}" for t in _TH)}
FROM (SELECT neuron, count(*) AS n_nodes FROM forest GROUP BY 1)
JOIN (SELECT neuron, count(*) FILTER (k = 0) AS n_edges, sum(weight)/1000 AS cable, count(*) AS n_center_samples,
  {', '.join(f"sum(CASE WHEN error <= {t} THEN weight ELSE 0 END)/sum(weight) AS cf{t}" for t in _TH)} FROM center GROUP BY 1) USING (neuron)
JOIN (SELECT neuron, count(*) AS n_surface_samples, {', '.join(f"avg(CASE WHEN error <= {t} THEN 1 ELSE 0 END) AS sf{t}" for t in _TH)},
  {', '.join(f"quantile_cont(error, {p/100}) AS s{p}" for p in (50, 90, 95))}, quantile_cont(excess, 0.9) AS sx90 FROM back GROUP BY 1) USING (neuron)
JOIN ({wquant('error', 'center', _CE)}) USING (neuron) JOIN ({wquant('center_dist', 'center', {'d50': 0.5})}) USING (neuron) JOIN ({wquant('excess', 'center', {'x90': 0.9})}) USING (neuron)""")
# Corners of the two triangles of every box side.
_SIDES = "(0,0,2,6), (1,0,6,4), (2,1,5,7), (3,1,7,3), (4,0,4,5), (5,0,5,1), (6,2,3,7), (7,2,7,6), (8,0,1,3), (9,0,3,2), (10,4,6,7), (11,4,7,5)"
_CORNERS = ", ".join(f"CASE WHEN {n} & {bit} > 0 THEN hi_{c} ELSE lo_{c} END AS {n}{c}" for n in "uvw" for bit, c in ((1, "x"), (2, "y"), (4, "z")))
put("surface_positions", FOREST, _NBOX, f"""
tri AS (SELECT neuron, face_id, {_CORNERS} FROM nbox CROSS JOIN (VALUES {_SIDES}) s(face_id, u, v, w)),
side AS (SELECT *, vx-ux AS ex, vy-uy AS ey, vz-uz AS ez, wx-ux AS fx, wy-uy AS fy, wz-uz AS fz FROM tri),
sized AS (SELECT *, sqrt((ey*fz-ez*fy)**2 + (ez*fx-ex*fz)**2 + (ex*fy-ey*fx)**2) / 2 AS area FROM side),
ran AS (SELECT *, sum(area) OVER (PARTITION BY neuron ORDER BY face_id) AS upto, sum(area) OVER (PARTITION BY neuron) AS total FROM sized),
slots AS (SELECT *, greatest(ceil(round((upto - area) / total * 500, 9) - 0.5), 0) AS f, least(ceil(round(upto / total * 500, 9) - 0.5), 500) AS l FROM ran WHERE total > 0 AND area > 0),
pts AS (SELECT *, unnest(range(CAST(f AS BIGINT), CAST(l AS BIGINT))) AS point_id FROM slots),
hashed AS (SELECT *, md5('{SURFACE_SEED}:' || neuron || ':' || point_id) AS h FROM pts),
rolled AS (SELECT *, sqrt(CAST('0x' || substr(h, 1, 7) AS BIGINT) / 268435456.0::DOUBLE) AS a, CAST('0x' || substr(h, 8, 7) AS BIGINT) / 268435456.0::DOUBLE AS b FROM hashed)""",
    select=f"SELECT neuron, point_id, CAST(face_id AS BIGINT) AS face_id, {', '.join(r(f'(1-a)*u{c} + a*(1-b)*v{c} + a*b*w{c}', f'p{c}', 3) for c in 'xyz')} FROM rolled")
put("surface_samples", select="SELECT DISTINCT l_suppkey AS neuron, CAST(200 AS BIGINT) AS n_points, CAST(200 AS BIGINT) AS n_ids FROM lineitem")
put("mesh_overlap", FOREST, EDGE, _SAMPLES, _NBOX, select=f"""
SELECT neuron, {r('f', 'inside_fraction', 4)}, {r('w', 'center_in_mesh_aabb_fraction', 4)}, CASE WHEN f < 0.1 THEN 'error' WHEN f < 0.9 THEN 'warning' ELSE 'ok' END AS overlap
FROM (SELECT neuron, avg(CASE WHEN i THEN 1 ELSE 0 END) AS f, sum(CASE WHEN i THEN weight ELSE 0 END)/sum(weight) AS w
  FROM (SELECT smp.*, sx >= least(lo_x, hi_x - (neuron % 5)*9000) - 1000 AND sx <= greatest(lo_x, hi_x - (neuron % 5)*9000) + 1000 AS i FROM smp JOIN nbox USING (neuron)) GROUP BY neuron)""")
put("point_in_mesh", FOREST, REGIONS, select="""
SELECT neuron, id, region FROM forest JOIN boxes ON x/1000 BETWEEN lo_x AND hi_x AND y/1000 BETWEEN lo_y AND hi_y AND z/1000 BETWEEN lo_z AND hi_z""")

# ---------------------------------------------------------------- retrieval
_P = 2147483647


def _sig(name: str, source: str) -> str:
    return f"""
v{name} AS (SELECT DISTINCT neuron, CAST(floor(x/1000/5) AS BIGINT) AS vx, CAST(floor(y/1000/5) AS BIGINT) AS vy, CAST(floor(z/1000/5) AS BIGINT) AS vz FROM forest {source}),
s{name} AS (SELECT neuron, p.i, min(((1 + (CAST(48271 AS BIGINT)*16807*(p.i+1)) % {_P - 1}) * code + (69621*(p.i+1)*(p.i+7)) % {_P}) % {_P}) AS h
  FROM (SELECT neuron, ((vx*73856093 + vy*19349663 + vz*83492791) % {_P} + {_P}) % {_P} AS code FROM v{name}) c CROSS JOIN (SELECT CAST(range AS BIGINT) AS i FROM range(0, 128)) p GROUP BY ALL)"""


_TOPK = """
sim AS (SELECT q.neuron AS query, c.neuron AS candidate, count(*) FILTER (q.h = c.h) / 128 AS j FROM sq q JOIN sc c ON c.i = q.i GROUP BY ALL),
prs AS (
  SELECT query, candidate, j, true AS same FROM sim WHERE query = candidate
  UNION ALL SELECT query, candidate, j, false FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY j DESC, candidate) AS n FROM sim WHERE query <> candidate) WHERE n <= 30)"""
_RANK = """
jac AS (
  SELECT p.*, shared, round(shared / (nq + nc - shared), 9) AS jaccard FROM (
    SELECT p.query, p.candidate, p.j, p.same, count(c.vx) AS shared FROM prs p JOIN vq q ON q.neuron = p.query
    LEFT JOIN vc c ON c.neuron = p.candidate AND c.vx = q.vx AND c.vy = q.vy AND c.vz = q.vz GROUP BY ALL) p
  JOIN (SELECT neuron AS query, count(*) AS nq FROM vq GROUP BY 1) USING (query) JOIN (SELECT neuron AS candidate, count(*) AS nc FROM vc GROUP BY 1) USING (candidate)),
ranks AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY jaccard DESC, j DESC, candidate) AS exact_rank FROM jac),
summ AS (
  SELECT query, max(jaccard) FILTER (same) AS paired_score, max(exact_rank) FILTER (same) AS paired_exact_rank, arg_min(candidate, exact_rank) FILTER (NOT same) AS best_unmatched,
    arg_min(jaccard, exact_rank) FILTER (NOT same) AS best_unmatched_score, max(j) FILTER (same) AS mj, count(*) FILTER (NOT same) AS n_hard_negatives FROM ranks GROUP BY query)"""
put("minhash_signature", FOREST, _sig("c", ""), select="SELECT neuron, CAST(i AS INTEGER) AS i, h FROM sc")
_Q = (FOREST, _sig("q", "WHERE id % 11 <> 10"), _sig("c", ""), _TOPK)
put("minhash_top_candidates", *_Q, select=f"SELECT query, candidate, {r('j', 'minhash_jaccard')}, same AS is_same_name_original FROM prs")
put("retrieval_incomplete", FOREST, _sig("q", "WHERE id % 11 <> 10"), _sig("c", "WHERE neuron % 3 = 0"), _TOPK, select="""
SELECT * FROM (SELECT query, n_hard, paired, CASE WHEN NOT paired THEN 'no original of the same name' WHEN n_hard < 30 THEN 'needs 30 competitors, found ' || n_hard END AS error
  FROM (SELECT query, count(*) FILTER (NOT same) AS n_hard, bool_or(same) AS paired FROM prs GROUP BY query)) WHERE error IS NOT NULL""")
put("voxel_jaccard_topk", *_Q, _RANK, select=f"SELECT query, candidate, shared, {r('jaccard', 'jaccard')}, exact_rank FROM ranks")
put("rerank_rank", *_Q, _RANK, select=f"""
SELECT query, {r('paired_score', 'paired_score')}, paired_exact_rank, best_unmatched, {r('best_unmatched_score', 'best_unmatched_score')},
  {r('paired_score - best_unmatched_score', 'delta_score')}, paired_exact_rank = 1 AS top1_is_same_name, {r('mj', 'paired_minhash_jaccard')}, n_hard_negatives FROM summ""")
put("retrieval_retention", *_Q, _RANK, select=f"""
SELECT count(*) AS n, {r('avg(CASE WHEN paired_exact_rank = 1 THEN 1 ELSE 0 END)', 'top1_rate')},
  {', '.join(r(f'quantile_cont({e}, {p})', f'{c}_{n}') for c, e in (('paired_score', 'paired_score'), ('delta_score', 'paired_score - best_unmatched_score')) for n, p in (('median', 0.5), ('q25', 0.25), ('q75', 0.75)))} FROM summ""")

# ------------------------------------------------------- listings and totals
put("order_matrix", LABELLED, _kept("2, 3, 4"), recursive=True, select=f"""
SELECT node_type, neuropil, {', '.join(f'CAST(sum(node_count) FILTER (branch_order = {o}) AS BIGINT) AS "{o}"' for o in range(1, 61))} FROM grid GROUP BY ALL""")
put("release_log_totals", FOREST, KIDS, _RELEASE, select="""
SELECT count(DISTINCT neuron) AS files, CAST(0 AS BIGINT) AS errors, count(*) AS n_nodes, count(*) FILTER (final_type = 1) AS type1_final, count(*) FILTER (root_to_type1) AS root_to_type1,
  count(*) FILTER (type1_removed) AS type1_removed, count(*) FILTER (type0_branch_to_type5) AS type0_branch_to_type5 FROM released""")
_FLAGS = {"remove_soma_branches_automatically": "s_suppkey % 3 = 0", "prun_soma_region": "s_suppkey % 4 = 0", "Multifurcation_Binarization": "s_acctbal > 3000", "Assign_synapse": "s_acctbal > 0"}
put("operation_totals", select=" UNION ALL ".join(
    f"SELECT count(*) AS files, '{n}' AS operation, count(*) FILTER ({c}) AS n, {r(f'count(*) FILTER ({c}) * 100.0 / count(*)', 'percent')} FROM supplier" for n, c in _FLAGS.items()))
put("listing_fingerprint", select="""
WITH s AS (SELECT l_suppkey || '|' || count(*) AS line FROM lineitem GROUP BY l_suppkey),
t AS (SELECT count(*) AS n, sum(CAST(('0x' || substr(sha256(line), 1, 13)) AS HUGEINT)) AS total FROM s)
SELECT n AS n_files, sha256(n || '|' || total) AS signature FROM t""")
_PICKED = "picked AS (SELECT neuron, neuron % 7 <> 3 AS has_raw FROM (SELECT DISTINCT neuron FROM forest) ORDER BY md5('42:' || neuron), neuron LIMIT 50)"
put("seeded_sample", FOREST, _PICKED, select="SELECT neuron FROM picked")
put("paired_sample", FOREST, _PICKED, select="SELECT neuron, has_raw FROM picked")
put("paired_sample_report", FOREST, _PICKED, select="""
SELECT count(*) AS sampled, count(*) FILTER (has_raw) AS raw_found, count(*) FILTER (NOT has_raw) AS raw_missing,
  coalesce(string_agg(neuron, ',' ORDER BY neuron) FILTER (NOT has_raw), '') AS missing FROM picked""")
put("long_segment_sort", FOREST, EDGE, _SCREEN, select="SELECT neuron, n_matching_parents, n_matching_long_segments FROM screen WHERE matched")
put("root_id_from_name", select="""
SELECT c_custkey, CASE WHEN c_custkey % 4 IN (0, 1) THEN CAST(720575940600000000 + c_custkey AS VARCHAR)
  WHEN c_custkey % 4 = 3 AND regexp_matches(c_name, '^[0-9]+$') THEN c_name END AS root_id FROM customer""")
put("unit_scaling", FOREST, select=f"SELECT neuron, id, {r('x*4', 'x', 4)}, {r('y*4', 'y', 4)}, {r('z*40', 'z', 4)}, {r('greatest(radius*1000, 0)', 'radius', 4)} FROM forest")
put("swc_text_lines", FOREST, select="""
SELECT neuron, id, printf('%d %d %.3f %.3f %.3f %.3f %d', id, type, x, y, z, radius, parent) AS line FROM forest""")

put("edge_diagnostics", FOREST, EDGE, _SAMPLES, _NBOX, _CENTER, _BACK, select=f"""
SELECT neuron, child_id, parent_id, {r('length_nm', 'length_nm', 3)}, CAST(n AS INTEGER) AS n_samples, soma_edge, {r('em', 'center_shell_error_mean_nm', 7)}, {r('xm', 'center_excess_mean_nm', 7)},
  {r('fit', 'center_fit_fraction_500nm', 7)}, {r('c90', 'center_shell_error_p90_nm', 7)}, points AS surface_points_assigned, {r('sm', 'surface_shell_error_mean_nm', 7)},
  {r('sfit', 'surface_fit_fraction_500nm', 7)}, {r('s90', 'surface_shell_error_p90_nm', 7)}
FROM (SELECT neuron, child_id, parent_id, any_value(length_nm) AS length_nm, count(*) AS n, bool_or(soma_edge) AS soma_edge, sum(weight*error)/sum(weight) AS em,
    sum(weight*excess)/sum(weight) AS xm, sum(CASE WHEN error <= 500 THEN weight ELSE 0 END)/sum(weight) AS fit FROM center GROUP BY neuron, child_id, parent_id)
JOIN ({wquant('error', 'center', {'c90': 0.9}, 'k', 'neuron, child_id')}) USING (neuron, child_id)
LEFT JOIN (SELECT neuron, child_id, count(*) AS points, avg(error) AS sm, avg(CASE WHEN error <= 500 THEN 1 ELSE 0 END) AS sfit, quantile_cont(error, 0.9) AS s90 FROM back GROUP BY ALL) USING (neuron, child_id)""")
put("radius_states", FOREST, """
thick AS (SELECT neuron, id, id = CASE neuron % 7 WHEN 0 THEN 0 WHEN 5 THEN 2 ELSE 1 END AS is_soma,
    ((CASE WHEN id <= 14 THEN CASE WHEN neuron % 7 = 4 THEN 9000 ELSE 300 END ELSE 50 END)::DOUBLE + radius) / 1000 AS r FROM forest),
base AS (SELECT neuron, quantile_cont(r, 0.5) AS m FROM thick WHERE NOT is_soma AND neuron % 7 NOT IN (0, 5) GROUP BY neuron)""", select="""
SELECT neuron, id, CASE WHEN is_soma THEN 'soma_seed' WHEN m IS NULL THEN 'uncertain' WHEN r/m <= 1.5 THEN 'neurite_like' WHEN r/m >= 2 THEN 'soma_like' ELSE 'uncertain' END AS radius_state
FROM thick LEFT JOIN base USING (neuron)""")
