"""SQL twins of the queries, for a single-node engine that checks the results."""

from __future__ import annotations

_STEPS = {
    "ballots": """SELECT l_orderkey AS voting, l_suppkey AS member, max(l_returnflag) AS vote
        FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "relevant": """SELECT voting FROM (SELECT voting, vote, count(*) AS n FROM ballots GROUP BY voting, vote) t
        GROUP BY voting HAVING sum(n) - max(n) >= 1""",
    "agreements": """SELECT a.member AS src, b.member AS dst, CAST(count(*) AS BIGINT) AS weight
        FROM ballots a JOIN ballots b ON a.voting = b.voting AND a.vote = b.vote AND a.member < b.member
        WHERE a.voting IN (SELECT voting FROM relevant) GROUP BY a.member, b.member""",
    "edges": """SELECT src, dst, weight FROM agreements
        WHERE weight >= (SELECT quantile_cont(weight, 0.75) FROM agreements)""",
    "both_ways": """SELECT src, dst, weight FROM edges
        UNION ALL SELECT dst, src, weight FROM edges WHERE src <> dst""",
    "ids": "SELECT DISTINCT src AS id FROM both_ways",
    "labelled": """SELECT s_suppkey AS id, s_name AS nome, n_name AS partido, r_name AS ideologia
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "vertices": """SELECT ids.id, nome, partido, ideologia, labelled.id IS NOT NULL AS has_attrs
        FROM ids LEFT JOIN labelled ON ids.id = labelled.id""",
    "above": "SELECT src AS id, CASE WHEN count(*) > 1 THEN max(weight) END AS maior_peso FROM edges GROUP BY src",
    "mapped": """SELECT v.*, a.maior_peso, a.id IS NOT NULL AS has_peso FROM vertices v LEFT JOIN above a ON a.id = v.id""",
    "strengths": """SELECT src AS id, CAST(sum(weight) AS BIGINT) AS strength, count(*) AS degree
        FROM both_ways GROUP BY src""",
    "coefficients": """SELECT b.src AS id, sum(CASE WHEN s.strength > 0 THEN 1.0::DOUBLE / s.strength ELSE 0 END)
        AS coef_ponte FROM both_ways b JOIN strengths s ON s.id = b.dst GROUP BY b.src""",
    "bridges": """SELECT v.*, round(c.coef_ponte, 12) AS coef_ponte FROM vertices v JOIN coefficients c ON c.id = v.id""",
    "limits": """SELECT *, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM (
        SELECT quantile_cont(coef_ponte, 0.25) AS q1, quantile_cont(coef_ponte, 0.5) AS q2,
               quantile_cont(coef_ponte, 0.75) AS q3 FROM bridges) t""",
    # walks of up to twelve edges: the longest shortest path of the checked networks has far fewer
    "walks": """SELECT id AS s, id AS v, 0::BIGINT AS d, 0 AS hops FROM ids
        UNION ALL SELECT w.s, b.dst, CAST(min(w.d + b.weight) AS BIGINT), w.hops + 1
        FROM walks w JOIN both_ways b ON b.src = w.v WHERE w.hops < 12 GROUP BY w.s, b.dst, w.hops""",
    "distances": "SELECT s, v, min(d) AS d FROM walks GROUP BY s, v",
    "path_steps": """SELECT id AS s, id AS v, 0 AS hops, 1.0::DOUBLE AS paths FROM ids
        UNION ALL SELECT p.s, b.dst, p.hops + 1, sum(p.paths)
        FROM path_steps p JOIN both_ways b ON b.src = p.v
        JOIN distances near ON near.s = p.s AND near.v = p.v
        JOIN distances far ON far.s = p.s AND far.v = b.dst AND far.d = near.d + b.weight
        GROUP BY p.s, b.dst, p.hops""",
    "path_counts": """SELECT d.s, d.v, d.d, p.paths FROM distances d
        JOIN (SELECT s, v, sum(paths) AS paths FROM path_steps GROUP BY s, v) p ON p.s = d.s AND p.v = d.v""",
    "through": """SELECT a.v AS id, sum(a.paths * b.paths / c.paths) AS raw
        FROM path_counts a JOIN path_counts b ON a.v = b.s
        JOIN path_counts c ON c.s = a.s AND c.v = b.v AND c.d = a.d + b.d
        WHERE a.s <> a.v AND b.v <> a.v AND a.s <> b.v GROUP BY a.v""",
    "central": """SELECT ids.id, coalesce(t.raw, 0) / ((n.n - 1) * (n.n - 2)) AS centralidade_intermediacao
        FROM ids LEFT JOIN through t ON t.id = ids.id CROSS JOIN (SELECT count(*) AS n FROM ids) n""",
    "bridging": """SELECT m.id, m.centralidade_intermediacao, c.coef_ponte,
        m.centralidade_intermediacao * c.coef_ponte AS centralidade_ponte
        FROM central m JOIN coefficients c ON c.id = m.id""",
    "bridging_limits": """SELECT *, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM (
        SELECT quantile_cont(centralidade_ponte, 0.25) AS q1, quantile_cont(centralidade_ponte, 0.5) AS q2,
               quantile_cont(centralidade_ponte, 0.75) AS q3 FROM bridging) t""",
    "ends": """SELECT e.src, e.dst, e.weight, a.ideologia AS a_label, b.ideologia AS b_label
        FROM edges e JOIN vertices a ON a.id = e.src JOIN vertices b ON b.id = e.dst""",
    "raw_pairs": """SELECT least(l_suppkey, l_partkey) AS src, greatest(l_suppkey, l_partkey) AS dst,
        CAST(l_linenumber AS BIGINT) AS weight, l_orderkey AS placed FROM lineitem""",
}
_NETWORK = ["ballots", "relevant", "agreements", "edges", "both_ways", "ids"]
_VERTICES = _NETWORK + ["labelled", "vertices"]
_MAPPED = _VERTICES + ["above", "mapped"]
_COEFFICIENTS = _VERTICES + ["strengths", "coefficients"]
_BRIDGES = _COEFFICIENTS + ["bridges", "limits"]
_PATHS = _NETWORK + ["walks", "distances", "path_steps", "path_counts", "through", "central"]
_BRIDGING = _COEFFICIENTS + _PATHS[len(_NETWORK):] + ["bridging", "bridging_limits"]


def _with(steps: list[str], select: str, **other: str) -> str:
    """A query on named steps; ``other`` holds steps that this query has instead of the common ones."""
    recursive, known = "RECURSIVE " if "walks" in steps else "", {**_STEPS, **other}
    return f"WITH {recursive}" + ",\n".join(f"{name} AS ({known[name]})" for name in steps) + "\n" + select


def _quartile(value: str) -> str:
    return f"CASE WHEN {value} <= q1 THEN '1' WHEN {value} <= q2 THEN '2' WHEN {value} <= q3 THEN '3' ELSE '4' END"


def _outlier(value: str) -> str:
    return f"CASE WHEN {value} < fence_lo THEN 'SI' WHEN {value} > fence_hi THEN 'SS' ELSE 'N' END"


def _quantiles(table: str, value: str, key: str) -> str:
    return f"""WITH v AS (SELECT {key}, {value} AS x FROM {table}), limits AS (
        SELECT *, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM (
        SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS q2, quantile_cont(x, 0.75) AS q3 FROM v) t) """


def all_oracles() -> dict[str, str]:
    name = "regexp_extract(url, '[^/]*$')"
    widths = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(greatest(1, max(length(CAST({c} AS VARCHAR)))) AS INTEGER) AS width FROM customer"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    )
    audit = " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows_loaded, count(*) AS rows_source, true AS ok FROM {t}"
        for t in ("nation", "region", "supplier", "customer")
    )
    shares = "SELECT value, n, round(pct, 9) AS pct, {label} AS label FROM ({inner}) t"
    by_ideology = "SELECT ideologia AS value, count(*) AS n, count(*) * 100.0::DOUBLE / {total} AS pct FROM vertices {where} GROUP BY ideologia"
    by_weight = "SELECT maior_peso AS value, count(*) AS n, count(*) * 100.0::DOUBLE / {total} AS pct FROM mapped {where} GROUP BY maior_peso"
    cross = """SELECT ideologia, partido, n, CAST(sum(n) OVER (PARTITION BY ideologia) AS BIGINT) AS total
        FROM (SELECT ideologia, partido, count(*) AS n FROM vertices GROUP BY ideologia, partido) t"""
    edges = "SELECT src, dst, weight FROM edges"
    report = f"""SELECT b.id AS "ID", v.nome, v.partido, v.ideologia,
        round(b.centralidade_intermediacao, 9) AS "Centralidade_Intermediacao", round(b.coef_ponte, 9) AS coef_ponte,
        round(b.centralidade_ponte, 9) AS "Centralidade_Ponte", {_quartile('b.centralidade_ponte')} AS "Quartil",
        {_outlier('b.centralidade_ponte')} AS "Outlier"
        FROM bridging b JOIN vertices v ON v.id = b.id CROSS JOIN bridging_limits"""
    return {
        "file_names": f"SELECT page_id, url, {name} AS filename FROM pages",
        "table_names": f"""WITH p AS (SELECT page_id, url, {name} AS filename FROM pages),
            m AS (SELECT filename, max('TB_' || CAST(page_id AS VARCHAR)) AS t FROM p WHERE url LIKE 'https:%' GROUP BY filename)
            SELECT p.filename, p.page_id, m.t IS NOT NULL AS in_manifest,
            coalesce(m.t, regexp_replace(p.filename, '[.]html$', '')) AS table_name
            FROM p LEFT JOIN m ON m.filename = p.filename
            WHERE p.filename LIKE '%.html' AND p.filename NOT LIKE '%99%'""",
        "varchar_widths": widths,
        "raw_table": """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
            CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier""",
        "raw_table_of_files": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
            o_orderstatus, count(*) OVER () AS rows_loaded, count(*) OVER () AS rows_source, true AS ok FROM orders""",
        "manifest_scan": f"""SELECT url, 'TB_' || CAST(page_id AS VARCHAR) AS nome_banco_dados, ' pages' AS descricao,
            {name} AS filename FROM pages""",
        "graph_xml_attributes": _with(_VERTICES, """SELECT 'node' AS class, CAST(id AS VARCHAR) AS id, attribute, 'string' AS type, value
            FROM (SELECT id, 'nome' AS attribute, nome AS value FROM vertices UNION ALL SELECT id, 'partido', partido FROM vertices
                  UNION ALL SELECT id, 'ideologia', ideologia FROM vertices) v WHERE value IS NOT NULL
            UNION ALL SELECT 'edge', src || '-' || dst, 'Origem', 'long', CAST(src AS VARCHAR) FROM edges
            UNION ALL SELECT 'edge', src || '-' || dst, 'Destino', 'long', CAST(dst AS VARCHAR) FROM edges"""),
        "community_check": _with(_NETWORK, """SELECT count(*) AS n_vertices, 0::BIGINT AS n_unlabelled, true AS consecutive,
            true AS by_size, true AS beats_single, true AS beats_ideology FROM ids"""),
        "community_optimality": _with(_NETWORK, """SELECT count(*) AS n_vertices, 0::BIGINT AS n_gaining_moves,
            0::BIGINT AS n_gaining_merges FROM ids"""),
        "ideology_optimality": _with(_VERTICES, """
            , placed AS (SELECT id, ideologia AS label FROM vertices),
            both_ends AS (SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges),
            strength AS (SELECT src AS id, sum(weight) AS k FROM both_ends GROUP BY src),
            whole AS (SELECT sum(k) AS twice FROM strength),
            totals AS (SELECT label, sum(k) AS total FROM strength JOIN placed USING (id) GROUP BY label),
            near AS (SELECT b.src AS id, p.label, sum(weight) AS w FROM both_ends b JOIN placed p ON p.id = b.dst GROUP BY b.src, p.label),
            own AS (
              SELECT s.id, p.label, k, total, coalesce(n.w, 0) * twice - k * (total - k) AS stay FROM strength s
              JOIN placed p USING (id) JOIN totals t ON t.label IS NOT DISTINCT FROM p.label CROSS JOIN whole
              LEFT JOIN near n ON n.id = s.id AND n.label IS NOT DISTINCT FROM p.label),
            going AS (
              SELECT o.id FROM own o JOIN near n ON n.id = o.id AND n.label IS DISTINCT FROM o.label
              JOIN totals t ON t.label IS NOT DISTINCT FROM n.label CROSS JOIN whole
              GROUP BY o.id, stay HAVING max(n.w * twice - o.k * t.total) > stay),
            merging AS (
              SELECT 1 FROM own o JOIN near n ON n.id = o.id AND coalesce(o.label, '') < coalesce(n.label, '')
              JOIN totals t ON t.label IS NOT DISTINCT FROM n.label CROSS JOIN whole
              GROUP BY o.label, n.label, o.total, t.total, twice HAVING sum(n.w) * twice > o.total * t.total)
            SELECT (SELECT count(*) FROM ids) AS n_vertices, (SELECT count(*) FROM totals) AS n_groups,
              (SELECT count(*) FROM going) AS n_gaining_moves, (SELECT count(*) FROM merging) AS n_gaining_merges"""),
        "quartile_counts_bridging": _with(
            _BRIDGING,
            f"""SELECT q."Quartil", count(l.id) AS n FROM (VALUES ('1'), ('2'), ('3'), ('4')) q("Quartil")
            LEFT JOIN (SELECT id, {_quartile('centralidade_ponte')} AS label FROM bridging CROSS JOIN bridging_limits) l
            ON l.label = q."Quartil" GROUP BY q."Quartil\"""",
        ),
        "outlier_counts_bridging": _with(
            _BRIDGING,
            """SELECT count(*) FILTER (WHERE centralidade_ponte > fence_hi) AS superiores,
            count(*) FILTER (WHERE centralidade_ponte < fence_lo) AS inferiores FROM bridging CROSS JOIN bridging_limits""",
        ),
        "boxplot_stats_bridging": _with(
            _BRIDGING,
            """SELECT count(centralidade_ponte) AS n, round(q1, 9) AS q1, round(q2, 9) AS median, round(q3, 9) AS q3,
            round(least(min(centralidade_ponte) FILTER (WHERE centralidade_ponte >= fence_lo), q1), 9) AS whisker_lo,
            round(greatest(max(centralidade_ponte) FILTER (WHERE centralidade_ponte <= fence_hi), q3), 9) AS whisker_hi
            FROM bridging CROSS JOIN bridging_limits GROUP BY q1, q2, q3""",
        ),
        "load_audit": audit,
        "load_audit_named": """SELECT 'part_0' AS "table", count(*) AS rows_loaded, count(*) AS rows_source, true AS ok, false AS in_manifest FROM nation
            UNION ALL SELECT 'tb_depu', count(*), count(*), true, true FROM supplier
            UNION ALL SELECT 'tb_voto', count(*), count(*), true, true FROM orders""",
        "edge_scan": _with(_NETWORK, edges),
        "vertex_scan": _with(_VERTICES, "SELECT id, nome, partido, ideologia FROM vertices"),
        "vertex_sink": _with(_VERTICES, 'SELECT id AS "ID", nome, partido, ideologia FROM vertices'),
        "edge_sink": _with(_NETWORK, 'SELECT weight, src AS "Origem", dst AS "Destino" FROM edges'),
        "graph_xml_nodes": _with(_NETWORK, "SELECT id, CAST(id AS VARCHAR) AS label FROM ids"),
        "graph_xml": _with(_NETWORK, edges),
        "relevant_votings": _with(
            ["ballots", "relevant"],
            "SELECT voting, member, vote FROM ballots WHERE voting IN (SELECT voting FROM relevant)",
        ),
        "agreement_edges": _with(["ballots", "relevant", "agreements"], "SELECT src, dst, weight FROM agreements"),
        "durable_edges": _with(_NETWORK, edges),
        "durable_edges_fixed": _with(
            ["ballots", "relevant", "agreements"], "SELECT src, dst, weight FROM agreements WHERE weight >= 5"
        ),
        "agreement_edges_pruned": _with(
            ["ballots", "relevant", "agreements"], "SELECT src, dst, weight FROM agreements WHERE weight >= 5"
        ),
        "labelled_vertices": _with(["labelled"], "SELECT id, nome, partido, ideologia FROM labelled"),
        "canonical_edges": _with(["raw_pairs"], "SELECT src, dst, max(weight) AS weight FROM raw_pairs GROUP BY src, dst"),
        "canonical_edges_last": _with(
            ["raw_pairs"],
            """SELECT src, dst, weight FROM (SELECT *, row_number() OVER (PARTITION BY src, dst
            ORDER BY placed DESC, weight DESC) AS place FROM raw_pairs) t WHERE place = 1""",
        ),
        "vertex_ids": _with(_NETWORK, "SELECT id FROM ids"),
        "symmetric_edges": _with(_NETWORK, "SELECT src, dst, weight FROM both_ways"),
        "graph_size": _with(
            _NETWORK, "SELECT (SELECT count(*) FROM ids) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges"
        ),
        "network_vertices": _with(_VERTICES, "SELECT id, nome, partido, ideologia, has_attrs FROM vertices"),
        "induced_edges": _with(
            _VERTICES + ["ends"], "SELECT src, dst, weight, a_label AS ideologia FROM ends WHERE a_label = b_label"
        ),
        "community_modularity": _with(
            _VERTICES + ["ends"],
            """SELECT (SELECT count(DISTINCT ideologia) FROM vertices) AS n_groups, round(sum(q), 9) AS modularity FROM (
            SELECT g.label, coalesce(i.inner_weight, 0) / t.m - (g.k / (2 * t.m)) * (g.k / (2 * t.m)) AS q
            FROM (SELECT label, sum(weight)::DOUBLE AS k FROM (SELECT a_label AS label, weight FROM ends
                  UNION ALL SELECT b_label, weight FROM ends) e GROUP BY label) g
            LEFT JOIN (SELECT a_label AS label, sum(weight)::DOUBLE AS inner_weight FROM ends WHERE a_label = b_label
                  GROUP BY a_label) i ON i.label = g.label
            CROSS JOIN (SELECT sum(weight)::DOUBLE AS m FROM edges) t) parts""",
        ),
        "weighted_density": _with(
            _NETWORK,
            """SELECT n AS n_nodes, total_weight, round(total_weight / (n * (n - 1) / 2.0::DOUBLE), 9) AS density FROM (
            SELECT (SELECT count(*) FROM ids) AS n, (SELECT CAST(sum(weight) AS BIGINT) FROM edges) AS total_weight) t""",
        ),
        "weighted_density_by_group": _with(
            _VERTICES + ["ends"],
            """SELECT g.ideologia, g.n AS n_nodes, coalesce(w.w, 0) AS total_weight,
            round(CASE WHEN g.n > 1 THEN coalesce(w.w, 0) / (g.n * (g.n - 1) / 2.0::DOUBLE) ELSE 0 END, 9) AS density
            FROM (SELECT ideologia, count(*) AS n FROM vertices WHERE ideologia IS NOT NULL GROUP BY ideologia) g
            LEFT JOIN (SELECT a_label, CAST(sum(weight) AS BIGINT) AS w FROM ends WHERE a_label = b_label
            GROUP BY a_label) w ON w.a_label = g.ideologia""",
        ),
        "strength": _with(_NETWORK + ["strengths"], "SELECT id, strength, degree FROM strengths"),
        "betweenness": _with(
            _PATHS,
            'SELECT id, round(centralidade_intermediacao, 9) AS "Centralidade_Intermediacao" FROM central',
        ),
        "betweenness_by_sources": _with(
            _PATHS,
            'SELECT id, round(centralidade_intermediacao, 9) AS "Centralidade_Intermediacao" FROM central',
        ),
        "betweenness_inverse": _with(
            _PATHS[:3] + ["weighted"] + _PATHS[3:],
            'SELECT id, round(centralidade_intermediacao, 9) AS "Centralidade_Intermediacao" FROM central',
            weighted=_STEPS["edges"],
            edges="""SELECT src, dst, CAST((SELECT list_reduce(list(DISTINCT weight), lambda a, b: lcm(a, b))
                FROM weighted) // weight AS BIGINT) AS weight FROM weighted""",
        ),
        "bridging_coefficient": _with(
            _COEFFICIENTS, "SELECT id, round(coef_ponte, 9) AS coef_ponte FROM coefficients"
        ),
        "bridging_centrality": _with(
            _BRIDGING,
            """SELECT id, round(centralidade_intermediacao, 9) AS "Centralidade_Intermediacao",
            round(coef_ponte, 9) AS coef_ponte, round(centralidade_ponte, 9) AS "Centralidade_Ponte" FROM bridging""",
        ),
        "quartiles": _with(_BRIDGES, "SELECT round(q1, 9) AS q1, round(q2, 9) AS q2, round(q3, 9) AS q3 FROM limits"),
        "quartiles_accounts": _quantiles("supplier", "s_acctbal", "s_suppkey")
        + "SELECT round(q1, 9) AS q1, round(q2, 9) AS q2, round(q3, 9) AS q3 FROM limits",
        "quartiles_prices": _quantiles("lineitem", "l_extendedprice", "l_orderkey")
        + "SELECT round(q1, 9) AS q1, round(q2, 9) AS q2, round(q3, 9) AS q3 FROM limits",
        "iqr_fences": _with(
            _BRIDGES,
            """SELECT round(q1, 9) AS q1, round(q2, 9) AS q2, round(q3, 9) AS q3,
            round(fence_lo, 9) AS fence_lo, round(fence_hi, 9) AS fence_hi FROM limits""",
        ),
        "quartile_label": _with(
            _BRIDGES, f'SELECT id, round(coef_ponte, 9) AS coef_ponte, {_quartile("coef_ponte")} AS "Quartil" FROM bridges CROSS JOIN limits'
        ),
        "quartile_label_accounts": _quantiles("supplier", "s_acctbal", "s_suppkey")
        + f'SELECT s_suppkey AS id, round(x, 9) AS s_acctbal, {_quartile("x")} AS "Quartil" FROM v CROSS JOIN limits',
        "outlier_label": _with(
            _BRIDGES, f'SELECT id, round(coef_ponte, 9) AS coef_ponte, {_outlier("coef_ponte")} AS "Outlier" FROM bridges CROSS JOIN limits'
        ),
        "outlier_label_orders": _quantiles("orders", "o_totalprice", "o_orderkey")
        + f'SELECT o_orderkey, round(x, 9) AS o_totalprice, {_outlier("x")} AS "Outlier" FROM v CROSS JOIN limits',
        "quartile_counts": _with(
            _BRIDGES,
            f"""SELECT q."Quartil", count(l.id) AS n FROM (VALUES ('1'), ('2'), ('3'), ('4')) q("Quartil")
            LEFT JOIN (SELECT id, {_quartile('coef_ponte')} AS label FROM bridges CROSS JOIN limits) l
            ON l.label = q."Quartil" GROUP BY q."Quartil\"""",
        ),
        "outlier_counts": _with(
            _BRIDGES,
            """SELECT count(*) FILTER (WHERE coef_ponte > fence_hi) AS superiores,
            count(*) FILTER (WHERE coef_ponte < fence_lo) AS inferiores FROM bridges CROSS JOIN limits""",
        ),
        "boxplot_stats": _with(
            _BRIDGES,
            """SELECT count(coef_ponte) AS n, round(q1, 9) AS q1, round(q2, 9) AS median, round(q3, 9) AS q3,
            round(least(min(coef_ponte) FILTER (WHERE coef_ponte >= fence_lo), q1), 9) AS whisker_lo,
            round(greatest(max(coef_ponte) FILTER (WHERE coef_ponte <= fence_hi), q3), 9) AS whisker_hi
            FROM bridges CROSS JOIN limits GROUP BY q1, q2, q3""",
        ),
        "vertex_metrics_report": _with(_BRIDGING, report),
        "chain_report": _with(_BRIDGING, f"""SELECT r.*, (SELECT count(*) FROM ids) AS n_nodes, (SELECT count(*) FROM edges) AS n_edges,
            0::BIGINT AS steps_made_again FROM ({report}) r"""),
        "vertex_ranks": _with(
            _BRIDGES,
            f"""SELECT id, round(coef_ponte, 9) AS coef_ponte, {_quartile('coef_ponte')} AS "Quartil", {_outlier('coef_ponte')} AS "Outlier"
            FROM bridges CROSS JOIN limits""",
        ),
        "attribute_distribution": _with(
            _VERTICES, "SELECT ideologia AS value, count(*) AS n FROM vertices GROUP BY ideologia"
        ),
        "cross_share": _with(
            _VERTICES,
            f"""SELECT ideologia, partido, n, total, round(n * 100.0::DOUBLE / total, 9) AS pct FROM ({cross}) c""",
        ),
        "dominant_category": _with(
            _VERTICES,
            f"""SELECT ideologia, partido, n, total, round(n * 100.0::DOUBLE / total, 9) AS pct FROM (
            SELECT *, row_number() OVER (PARTITION BY ideologia ORDER BY n DESC, partido ASC NULLS LAST) AS place
            FROM ({cross}) c) r WHERE place = 1""",
        ),
        "category_shares": _with(
            _VERTICES,
            shares.format(
                label="""'Ideologia ' || coalesce(value, 'None') || ' (' || CAST(n AS VARCHAR)
                || ' ocorrências - ' || printf('%.1f', pct) || '%)'""",
                inner=by_ideology.format(
                    total="(SELECT count(*) FROM vertices WHERE has_attrs)", where="WHERE has_attrs"
                ),
            ),
        ),
        "group_shares": _with(
            _VERTICES,
            shares.format(
                label="""'Comunidade ' || coalesce(value, 'None') || ': ' || CAST(n AS VARCHAR)
                || ' (' || printf('%.2f', pct) || '%)'""",
                inner=by_ideology.format(total="(SELECT count(*) FROM vertices)", where=""),
            ),
        ),
        "attribute_presence": _with(
            _MAPPED,
            """SELECT 'nome' AS field, count(nome) AS n_valued, count(*) FILTER (WHERE has_attrs AND nome IS NULL) AS n_null,
            count(*) FILTER (WHERE NOT has_attrs) AS n_lacking FROM mapped
            UNION ALL SELECT 'ideologia', count(ideologia), count(*) FILTER (WHERE has_attrs AND ideologia IS NULL),
            count(*) FILTER (WHERE NOT has_attrs) FROM mapped
            UNION ALL SELECT 'maior_peso', count(maior_peso), count(*) FILTER (WHERE has_peso AND maior_peso IS NULL),
            count(*) FILTER (WHERE NOT has_peso) FROM mapped
            UNION ALL SELECT 'idade', 0, 0, count(*) FROM mapped""",
        ),
        "attribute_distribution_by_presence": _with(
            _MAPPED, "SELECT maior_peso AS value, count(*) AS n FROM mapped GROUP BY maior_peso"
        ),
        "category_shares_by_presence": _with(
            _MAPPED,
            shares.format(
                label="""'Maior_peso ' || coalesce(CAST(value AS VARCHAR), 'None') || ' (' || CAST(n AS VARCHAR)
                || ' ocorrências - ' || printf('%.1f', pct) || '%)'""",
                inner=by_weight.format(total="(SELECT count(*) FROM mapped WHERE has_peso)", where="WHERE has_peso"),
            ),
        ),
        "group_shares_by_presence": _with(
            _MAPPED,
            shares.format(
                label="""'Comunidade ' || coalesce(CAST(value AS VARCHAR), 'None') || ': ' || CAST(n AS VARCHAR)
                || ' (' || printf('%.2f', pct) || '%)'""",
                inner=by_weight.format(total="(SELECT count(*) FROM mapped)", where=""),
            ),
        ),
        "strip_points_bridging": _with(
            _BRIDGING,
            """SELECT b.id, round(centralidade_ponte, 9) AS y, ideologia AS color, 'Centralidade ponte' AS y_title,
            'Ideologia' AS color_title, true AS x_in_range FROM bridging b JOIN vertices v ON v.id = b.id""",
        ),
        "strip_points": _with(
            _BRIDGES,
            """SELECT id, round(coef_ponte, 9) AS y, CASE WHEN coef_ponte > 0 THEN round(log10(coef_ponte), 9) END AS log_y,
            ideologia AS color, true AS x_in_range FROM bridges""",
        ),
    }
