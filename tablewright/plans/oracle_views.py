"""The derived views as SQL text, for stating expected results independently."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "customer_account": """
        WITH c AS (SELECT max(o_orderdate) - INTERVAL 180 DAY AS cut FROM orders),
        h AS (SELECT o_custkey, max(o_orderdate) AS last_dt,
                sum(CASE WHEN o_orderdate < cut THEN 1 ELSE 0 END) AS n_orders,
                sum(CASE WHEN o_orderdate < cut THEN o_totalprice ELSE 0 END) AS total_price,
                sum(CASE WHEN o_orderdate < cut AND o_orderpriority LIKE '1-%' THEN 1 ELSE 0 END)
                  AS n_urgent
              FROM orders CROSS JOIN c GROUP BY o_custkey)
        SELECT c_custkey AS cust_id, c_nationkey AS nation, c_mktsegment AS plan,
               c_acctbal AS acctbal, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders,
               coalesce(total_price, 0.0) AS total_price,
               CAST(coalesce(n_urgent, 0) AS BIGINT) AS n_urgent,
               CASE WHEN last_dt IS NULL OR last_dt < cut THEN 'True' ELSE 'False' END AS churn
        FROM customer CROSS JOIN c LEFT JOIN h ON o_custkey = c_custkey""",
    "ratings": """
        SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
               CAST(CAST(ceil(l_quantity / 5) AS INT) AS VARCHAR) AS rating
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "items": """
        SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS title, p_brand AS author
        FROM part""",
    "priced_lines": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax, p_retailprice,
               CAST(p_size AS DOUBLE) AS p_size, l_extendedprice AS label
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "doc_features": """
        SELECT l.doc_id, lang, quality, toxic, CAST(n_chars AS DOUBLE) AS n_chars,
               CAST(length(text) - length(replace(text, ' ', '')) AS DOUBLE) AS n_spaces,
               CAST(length(text) - length(replace(text, '.', '')) AS DOUBLE) AS n_periods,
               CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE)
                 / greatest(length(text), 1) AS e_ratio
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "expression": """
        SELECT vec_id, label, embedding::DOUBLE[] AS embedding FROM embeddings""",
    "genotype": """
        SELECT concat('S', CAST(s_nationkey AS VARCHAR)) AS sample,
               concat_ws(':', 'chr1', p_brand) AS variant,
               CAST(least(2, sum(CASE WHEN l_discount >= 0.095 AND l_quantity > 45 THEN 1
                                      ELSE 0 END)) AS INT) AS alt_count
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
        GROUP BY s_nationkey, p_brand""",
    "user_event_matrix": """
        SELECT user_id, sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END) AS v_click,
               sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END) AS v_view,
               sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) AS v_purchase,
               sum(CASE WHEN event_type = 'signup' THEN value ELSE 0 END) AS v_signup,
               sum(CASE WHEN event_type = 'error' THEN value ELSE 0 END) AS v_error
        FROM events GROUP BY user_id""",
    "scored": """
        SELECT doc_id, CAST(quality AS DOUBLE) AS label, n_periods / n_chars AS score,
               CAST(CASE WHEN n_periods > 20 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction
        FROM doc_features""",
    "guesses": """
        SELECT doc_id, lang AS label,
               CASE WHEN e_ratio < 0.095 THEN 'es' WHEN e_ratio < 0.13 THEN 'en'
                    WHEN e_ratio < 0.165 THEN 'fr' ELSE 'de' END AS prediction
        FROM doc_features""",
    "panel": """
        SELECT concat('S', CAST(n_nationkey AS VARCHAR)) AS sample,
               split_part(r_name, ' ', 1) AS population
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
}

NEEDS = {"scored": ["doc_features"], "guesses": ["doc_features"]}


def over(views: str, body: str) -> str:
    """``body`` with the named views (space-separated) stated in front of it.

    A body that needs expressions of its own starts with a comma and a name.
    """
    names: list[str] = []
    for view in views.split():
        for name in [*NEEDS.get(view, []), view]:
            if name not in names:
                names.append(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    return f"WITH {head}\n{body}"


def unit(key: str, seed: int, purpose: str) -> str:
    """The key hash in [0, 1) as SQL."""
    digits = f"substr(md5(concat_ws(':', '{seed}:{purpose}', CAST({key} AS VARCHAR))), 1, 8)"
    return f"(CAST(('0x' || {digits}) AS BIGINT) / CAST(4294967296.0 AS DOUBLE))"
