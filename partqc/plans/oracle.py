"""DuckDB oracle SQL for the registered queries (same column names, floats
rounded to 6 decimals). Queries whose result depends on a fitted model have
no entry here; their tests check invariants instead.
"""

from __future__ import annotations

EV = """(SELECT event_id,
       CAST(event_type = 'error' AS INTEGER) AS y,
       value,
       CAST(user_id AS DOUBLE) AS user_id,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events)"""

EV_DIRTY = """(SELECT event_id,
       CAST(event_type = 'error' AS INTEGER) AS y,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE value END AS value,
       CAST(user_id AS DOUBLE) AS user_id,
       CASE WHEN event_id % 10 = 5 THEN 'NaN'::DOUBLE
            ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
  FROM events)"""

EV_SCORED = f"""(SELECT event_id, y, value, user_id, k,
       value / (value + 20.0) AS p1,
       CAST(value / (value + 20.0) >= 0.5 AS DOUBLE) AS prediction
  FROM {EV})"""


def u32(seed, key: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT"


def h(seed, key: str) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


GRID = "(VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted)"

EM_DIM = 64
EM_MIN = "(SELECT vec_id, embedding FROM embeddings WHERE label = 5)"
EM_DIST = (
    "sqrt(list_sum(list_transform(range(64), lambda i: "
    "(CAST(a.embedding[i + 1] AS DOUBLE) - CAST(b.embedding[i + 1] AS DOUBLE)) * "
    "(CAST(a.embedding[i + 1] AS DOUBLE) - CAST(b.embedding[i + 1] AS DOUBLE)))))")
EM_NEIGHBOURS = f"""
  SELECT vec_id, rank, neighbour, distance FROM (
    SELECT a.vec_id, b.vec_id AS neighbour, {EM_DIST} AS distance,
           row_number() OVER (PARTITION BY a.vec_id ORDER BY {EM_DIST}, b.vec_id) AS rank
      FROM {EM_MIN} a JOIN {EM_MIN} b ON a.vec_id <> b.vec_id)
  WHERE rank <= 5"""

# Synthetic rows: draws by md5('2:<tag>:<i>'), base by dense index in key order.
SMOTE_DRAWS = f"""
  WITH mi AS {EM_MIN},
  sizes AS (SELECT (SELECT count(*) FROM embeddings WHERE label <> 5) - (SELECT count(*) FROM mi) AS n_new,
                   (SELECT count(*) FROM mi) AS m),
  ids AS (SELECT unnest(range(n_new)) AS new_id, m FROM sizes),
  draws AS (SELECT new_id,
                   ('0x' || substr(md5('2:b:' || CAST(new_id AS VARCHAR)), 1, 15))::BIGINT % m AS idx,
                   1 + ('0x' || substr(md5('2:k:' || CAST(new_id AS VARCHAR)), 1, 8))::BIGINT % 5 AS rank,
                   ('0x' || substr(md5('2:u:' || CAST(new_id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0 AS step
              FROM ids),
  idx AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY vec_id) - 1 AS idx FROM mi),
  nb AS ({EM_NEIGHBOURS}),
  srows AS (SELECT d.new_id, i.vec_id AS base, nb.neighbour, d.step,
                  i.embedding AS xb, n.embedding AS xn
             FROM draws d JOIN idx i ON d.idx = i.idx
             JOIN nb ON nb.vec_id = i.vec_id AND nb.rank = d.rank
             JOIN mi n ON n.vec_id = nb.neighbour)"""


_TEST_PART = f"""
        WITH b AS (SELECT event_id, y FROM {EV} WHERE y = 1 UNION ALL SELECT event_id, y FROM (
               SELECT *, row_number() OVER (ORDER BY {h(13, 'event_id')}, event_id) AS r FROM {EV} WHERE y = 0)
               WHERE r <= (SELECT count(*) FROM {EV} WHERE y = 1)),
             t AS (SELECT *, row_number() OVER (ORDER BY {h(42, 'event_id')}, event_id) AS r FROM b)
        SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS keys, CAST(sum(y) AS BIGINT) AS positive, 0::BIGINT AS off
          FROM t WHERE r <= (SELECT ceil(0.2 * count(*)) FROM b)"""

ORACLE: dict[str, str] = {
    "csv_scan": f"SELECT * FROM {EV}",
    "alert_messages": f"""
        SELECT CAST(value AS VARCHAR) AS key,
               CASE WHEN value IS NULL THEN '{{"prediction":' || CAST(CAST(y AS DOUBLE) AS VARCHAR) || '}}'
                    ELSE '{{"timCycle":"' || CAST(value AS VARCHAR) || '","prediction":'
                         || CAST(CAST(y AS DOUBLE) AS VARCHAR) || '}}' END AS value
          FROM {EV_DIRTY}""",
    "drop_columns": """
        SELECT event_id, user_id, value, CAST(event_type = 'error' AS INTEGER) AS y FROM events""",
    "select_columns": f"SELECT event_id, y FROM {EV}",
    "json_flatten": f"""
        SELECT CAST(y AS DOUBLE) AS reason, CAST(event_id AS DOUBLE) AS event_id, value, user_id, k
          FROM {EV_DIRTY}""",
    "attach_metric": f"""
        SELECT event_id, y, prediction,
               round(sqrt(avg((prediction - y) * (prediction - y)) OVER ()), 6) AS rmse
          FROM {EV_SCORED}""",
    "derive_label": """
        SELECT event_id, CASE WHEN nullif(event_type, 'click') = 'view' THEN 0 ELSE 1 END AS reason
          FROM events""",
    "filter_class": f"SELECT * FROM {EV} WHERE y = 0",
    "drop_incomplete": f"""
        SELECT * FROM {EV_DIRTY}
         WHERE event_id IS NOT NULL AND y IS NOT NULL
           AND value IS NOT NULL AND NOT isnan(value)
           AND user_id IS NOT NULL AND NOT isnan(user_id)
           AND k IS NOT NULL AND NOT isnan(k)""",
    "threshold_class": f"""
        SELECT event_id, round(value / (value + 20.0), 6) AS p1,
               CAST(value / (value + 20.0) >= 0.5 AS INTEGER) AS prediction
          FROM {EV}""",
    "threshold_ratio": f"""
        SELECT event_id,
               CASE WHEN (value / (value + 20.0)) / 0.82 > (1.0 - value / (value + 20.0)) / 0.18
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
          FROM {EV}""",
    "first_rows": f"SELECT * FROM {EV} ORDER BY event_id LIMIT 5",
    "class_counts": f"SELECT y, count(*) AS count FROM {EV} GROUP BY y",
    "imbalance_ratio": f"""
        SELECT n_major, n_minor, CAST(floor(n_major / n_minor) AS INTEGER) AS ratio
          FROM (SELECT CAST(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_major,
                       CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_minor FROM {EV})""",
    "class_share": f"""
        SELECT y, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
          FROM {EV} GROUP BY y""",
    "class_share_labels": """
        SELECT y, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share
          FROM (SELECT CAST(quality = 0 AS INTEGER) AS y FROM labels) GROUP BY y""",
    "imbalance_ratio_lineitem": """
        SELECT n_major, n_minor, CAST(floor(n_major / n_minor) AS INTEGER) AS ratio
          FROM (SELECT CAST(sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_major,
                       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_minor
                  FROM lineitem)""",
    "describe_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean,
                   round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min,
                   round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
                   round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max
              FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM {EV})"""
        for c in ["y", "value", "user_id", "k"]),
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM {EV}"
        for a in ["y", "value", "user_id", "k"] for b in ["y", "value", "user_id", "k"]),
    "undersample_bernoulli": f"""
        WITH c AS (SELECT sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS nmaj,
                          sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS nmin FROM {EV}),
             r AS (SELECT floor(nmaj / nmin) AS ratio FROM c)
        SELECT e.* FROM {EV} e, r
         WHERE e.y = 1
            OR (e.y = 0 AND (r.ratio < 1
                OR {u32(13, 'e.event_id')} < CAST(ceil((1.0 / r.ratio) * 4294967296.0) AS BIGINT)))""",
    "undersample_exact": f"""
        WITH maj AS (SELECT *, row_number() OVER (ORDER BY {h(13, 'event_id')}, event_id) AS rn
                       FROM {EV} WHERE y = 0),
             n AS (SELECT count(*) AS n FROM {EV} WHERE y = 1)
        SELECT event_id, y, value, user_id, k FROM maj, n WHERE rn <= n.n
        UNION ALL SELECT * FROM {EV} WHERE y = 1""",
    "split_weighted": f"""
        SELECT event_id,
               CASE WHEN {u32(13, 'event_id')} < CAST(ceil(0.8 * 4294967296.0) AS BIGINT)
                    THEN 'train' ELSE 'test' END AS split
          FROM {EV}""",
    "split_exact": f"""
        SELECT event_id,
               CASE WHEN row_number() OVER (ORDER BY {h(42, 'event_id')}, event_id)
                         <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
          FROM {EV}""",
    "shuffle_rows": f"""
        SELECT event_id, row_number() OVER (ORDER BY {h(7, 'event_id')}, event_id) AS position
          FROM {EV}""",
    "undersample_keyless": """
        SELECT y, count, 0::BIGINT AS moved FROM (SELECT unnest([0, 1]) AS y, count(*) FILTER (l_returnflag = 'R') AS count FROM lineitem)""",
    "split_keyless": """
        SELECT 'test' AS split, CAST(ceil(0.2 * count(*)) AS BIGINT) AS count FROM lineitem
        UNION ALL SELECT 'train', count(*) - CAST(ceil(0.2 * count(*)) AS BIGINT) FROM lineitem""",
    "union_classes": f"SELECT * FROM {EV} WHERE y = 0 UNION ALL SELECT * FROM {EV} WHERE y = 1",
    "smote_neighbours": f"""
        SELECT vec_id, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 6) AS distance
          FROM ({EM_NEIGHBOURS})""",
    "smote_rows": SMOTE_DRAWS + """
        SELECT new_id, base, neighbour, CAST(position AS INTEGER) AS position,
               round(CAST(xb[position + 1] AS DOUBLE)
                     + step * (CAST(xn[position + 1] AS DOUBLE) - CAST(xb[position + 1] AS DOUBLE)), 6) AS value
          FROM (SELECT *, unnest(range(64)) AS position FROM srows)""",
    "smote_neighbours_ev": f"""
        WITH mi AS (SELECT event_id, value, user_id, k FROM {EV} WHERE y = 1),
             d AS (SELECT a.event_id, b.event_id AS neighbour, sqrt((a.value - b.value) * (a.value - b.value)
                          + (a.user_id - b.user_id) * (a.user_id - b.user_id) + (a.k - b.k) * (a.k - b.k)) AS distance
                     FROM mi a JOIN mi b ON a.event_id <> b.event_id),
             r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY distance, neighbour) AS rank FROM d)
        SELECT event_id, CAST(rank AS INTEGER) AS rank, neighbour, round(distance, 6) AS distance FROM r WHERE rank <= 5""",
    "smote_lsh_check": f"""
        SELECT 'EV' AS view, 5 * sum(y)::BIGINT AS n, 0::BIGINT AS off, true AS recalled,
               CAST(sum(1 - y) - sum(y) AS BIGINT) AS n_new FROM {EV}
        UNION ALL SELECT 'EM', CAST(5 * sum(y) AS BIGINT), 0, true, CAST(sum(1 - y) - sum(y) AS BIGINT)
          FROM (SELECT CAST(label = 5 AS INT) AS y FROM embeddings)""",
    "smote_counts": """
        SELECT y, count AS count FROM (
          SELECT 0 AS y, count(*) AS count FROM embeddings WHERE label <> 5
          UNION ALL
          SELECT 1 AS y, count(*) FROM embeddings WHERE label <> 5)""",
    "assemble_features": f"""
        WITH v AS (SELECT * FROM {EV_DIRTY}
                    WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL
                      AND NOT isnan(user_id) AND k IS NOT NULL AND NOT isnan(k))
        SELECT event_id, 0 AS position, round(value, 6) AS value FROM v
        UNION ALL SELECT event_id, 1, round(user_id, 6) FROM v
        UNION ALL SELECT event_id, 2, round(k, 6) FROM v""",
    "scale_minmax": f"""
        WITH t AS (SELECT * FROM {EV}
                    WHERE {u32(13, 'event_id')} < CAST(ceil(0.8 * 4294967296.0) AS BIGINT)),
             s AS (SELECT min(value) AS a0, max(value) AS b0, min(user_id) AS a1, max(user_id) AS b1,
                          min(k) AS a2, max(k) AS b2 FROM t)
        SELECT event_id, 0 AS position,
               round(CASE WHEN b0 = a0 THEN 0.5 ELSE (value - a0) * (1.0 / (b0 - a0)) END, 6) AS value
          FROM {EV}, s
        UNION ALL SELECT event_id, 1,
               round(CASE WHEN b1 = a1 THEN 0.5 ELSE (user_id - a1) * (1.0 / (b1 - a1)) END, 6) FROM {EV}, s
        UNION ALL SELECT event_id, 2,
               round(CASE WHEN b2 = a2 THEN 0.5 ELSE (k - a2) * (1.0 / (b2 - a2)) END, 6) FROM {EV}, s""",
    "scale_standard": " UNION ALL ".join(
        f"""SELECT event_id, {i} AS position,
                   round(CASE WHEN sd = 0 THEN 0.0 ELSE ({c} - mu) / sd END, 6) AS value
              FROM {EV}, (SELECT avg({c}) AS mu, stddev_pop({c}) AS sd FROM {EV})"""
        for i, c in enumerate(["value", "user_id", "k"])),
    "rmse": f"SELECT round(sqrt(avg((prediction - y) * (prediction - y))), 6) AS rmse FROM {EV_SCORED}",
    "confusion_matrix": f"""
        SELECT g.actual, g.predicted, CAST(count(s.y) AS BIGINT) AS count
          FROM {GRID} LEFT JOIN {EV_SCORED} s ON s.y = g.actual AND s.prediction = g.predicted
         GROUP BY g.actual, g.predicted""",
    "binary_metrics": f"""
        SELECT round(avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               round(coalesce(sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END)
                     / nullif(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END), 0), 0.0), 6) AS precision,
               round(coalesce(sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END)
                     / nullif(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END), 0), 0.0), 6) AS recall
          FROM {EV_SCORED}""",
    "roc_curve": f"""
        WITH c AS (SELECT floor(value) AS score, sum(y) AS pos, sum(1 - y) AS neg FROM {EV} GROUP BY 1),
             t AS (SELECT sum(pos) AS p, sum(neg) AS n FROM c)
        SELECT CAST(score AS DOUBLE) AS threshold,
               round(sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) / t.n, 6) AS fpr,
               round(sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) / t.p, 6) AS tpr
          FROM c, t
        UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""",
    "roc_auc": f"""
        WITH c AS (SELECT floor(value) AS score, sum(y) AS pos, sum(1 - y) AS neg FROM {EV} GROUP BY 1),
             r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below FROM c)
        SELECT round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS auc FROM r""",
    "classification_report": f"""
        WITH s AS {EV_SCORED},
        c AS (SELECT sum(CASE WHEN y = 0 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS c00,
                     sum(CASE WHEN y = 0 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS c01,
                     sum(CASE WHEN y = 1 AND prediction = 0 THEN 1 ELSE 0 END)::DOUBLE AS c10,
                     sum(CASE WHEN y = 1 AND prediction = 1 THEN 1 ELSE 0 END)::DOUBLE AS c11 FROM s),
        k AS (SELECT '0' AS class, coalesce(c00 / nullif(c00 + c10, 0), 0.0) AS p,
                     coalesce(c00 / nullif(c00 + c01, 0), 0.0) AS r, c00 + c01 AS sup FROM c
              UNION ALL
              SELECT '1', coalesce(c11 / nullif(c11 + c01, 0), 0.0),
                     coalesce(c11 / nullif(c11 + c10, 0), 0.0), c10 + c11 FROM c),
        f AS (SELECT class, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0.0) AS f1, sup FROM k),
        tot AS (SELECT c00 + c01 + c10 + c11 AS n, c00 + c11 AS ok FROM c)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
               CAST(sup AS BIGINT) AS support FROM f
        UNION ALL SELECT 'accuracy', NULL, NULL, round(ok / n, 6), CAST(n AS BIGINT) FROM tot
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6),
                         CAST(sum(sup) AS BIGINT) FROM f
        UNION ALL SELECT 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6),
                         round(sum(f1 * sup) / sum(sup), 6), CAST(sum(sup) AS BIGINT) FROM f""",
    "threshold_sweep": f"""
        WITH s AS {EV_SCORED},
             c AS (SELECT CAST(cutoff AS DOUBLE) AS cutoff FROM (VALUES (0.3), (0.5), (0.7), (0.9)) v(cutoff))
        SELECT c.cutoff, g.actual, g.predicted,
               CAST(sum(CASE WHEN s.y = g.actual AND CAST(s.p1 >= c.cutoff AS INTEGER) = g.predicted
                             THEN 1 ELSE 0 END) AS BIGINT) AS count
          FROM c CROSS JOIN {GRID} CROSS JOIN s
         GROUP BY c.cutoff, g.actual, g.predicted""",
    "stream_parse": f"""
        SELECT CAST(y AS DOUBLE) AS reason, CAST(event_id AS DOUBLE) AS event_id, value, user_id, k
          FROM {EV_DIRTY}""",
    "stream_restart": f"""
        SELECT CAST(y AS DOUBLE) AS reason, CAST(event_id AS DOUBLE) AS event_id, value, user_id, k
          FROM {EV}""",
    "csv_reordered": f"SELECT * FROM {EV}",
    "correlation_dirty": f"""
        WITH v AS (SELECT * FROM {EV_DIRTY} WHERE value IS NOT NULL AND NOT isnan(value) AND user_id IS NOT NULL
                    AND NOT isnan(user_id) AND k IS NOT NULL AND NOT isnan(k))
        """ + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM v"
        for a in ("y", "value", "user_id", "k") for b in ("y", "value", "user_id", "k")),
    "correlation_wide": """
        WITH x AS (SELECT vec_id, unnest(range(64)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)
        SELECT 'c' || a.i AS col_a, 'c' || b.i AS col_b, round(corr(a.v, b.v), 6) AS r
          FROM x a JOIN x b USING (vec_id) GROUP BY a.i, b.i""",
    "describe_lineitem": " UNION ALL ".join(f"""
        SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std,
               round(CAST(min({c}) AS DOUBLE), 6) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25,
               round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50, round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75,
               round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"""
                                            for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")),
    # Test part: a fifth, rounded up, of twice the minority rows.
    "model_roundtrip_check": f"SELECT CAST(ceil(0.2 * 2 * count(*)) AS BIGINT) AS n, 0::BIGINT AS differ FROM {EV} WHERE y = 1",
    "class_probability_check": f"SELECT CAST(ceil(0.2 * 2 * count(*)) AS BIGINT) AS n, 0::BIGINT AS off FROM {EV} WHERE y = 1",
    "batch_score_check": f"SELECT count(*) AS n, 0::BIGINT AS off FROM {EV}",
    "rf_entropy_check": _TEST_PART,
    "rf_gini_100_check": _TEST_PART,
    "logreg_check": _TEST_PART,
    "compare_confusion": f"""
        WITH m AS (SELECT vec_id, CAST(label = 5 AS INT) AS y FROM embeddings),
        b AS (SELECT * FROM m WHERE y = 1 UNION ALL SELECT vec_id, y FROM (
              SELECT *, row_number() OVER (ORDER BY {h(13, 'vec_id')}, vec_id) AS r FROM m WHERE y = 0)
              WHERE r <= (SELECT count(*) FROM m WHERE y = 1)),
        t AS (SELECT 'undersample' AS sampling, y, row_number() OVER (ORDER BY {h(42, 'vec_id')}, vec_id) AS r,
                     ceil(0.2 * (SELECT count(*) FROM b)) AS n FROM b
              UNION ALL
              SELECT 'smote', y, row_number() OVER (ORDER BY {h(42, 'vec_id')}, vec_id),
                     ceil(0.2 * (SELECT count(*) FROM m)) FROM m)
        SELECT sampling, model, count(*) AS n, CAST(sum(y) AS BIGINT) AS positive
          FROM t, (SELECT unnest(['logistic', 'forest_entropy', 'forest_gini']) AS model) WHERE r <= n GROUP BY sampling, model""",
    "compare_roc_check": """
        SELECT sampling, model, 0.0::DOUBLE AS x0, 0.0::DOUBLE AS y0, 1.0::DOUBLE AS x1, 1.0::DOUBLE AS y1, 0::BIGINT AS falls,
               true AS agrees
          FROM (SELECT unnest(['undersample', 'smote']) AS sampling),
               (SELECT unnest(['logistic', 'forest_entropy', 'forest_gini']) AS model)""",
    "models_learn_check": """
        SELECT model, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys,
               CAST(sum(CAST(l_quantity > 25 OR l_discount > 0.05 AS INT)) AS BIGINT) AS positive, true AS learned
          FROM lineitem, (SELECT unnest(['logistic', 'forest_entropy', 'forest_gini', 'production']) AS model) WHERE l_linenumber = 5 GROUP BY model""",
    "stream_score_check": f"""
        SELECT count(*) AS n, 0::BIGINT AS differ FROM {EV_DIRTY}
         WHERE value IS NOT NULL AND NOT isnan(value) AND k IS NOT NULL AND NOT isnan(k)""",
    "confusion_dirty": f"""
        WITH s AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 <> 0 THEN y END AS a,
                          CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 <> 0 THEN CAST(prediction AS INT) END AS p
                     FROM {EV_SCORED}),
        c AS (SELECT a, p, count(*) AS n FROM s GROUP BY a, p)
        SELECT coalesce(CAST(g.actual AS VARCHAR), 'other') AS actual, coalesce(CAST(g.predicted AS VARCHAR), 'other') AS predicted,
               CAST(coalesce(n, 0) AS BIGINT) AS count
          FROM (SELECT * FROM {GRID} UNION SELECT a, p FROM c) g
          LEFT JOIN c ON c.a IS NOT DISTINCT FROM g.actual AND c.p IS NOT DISTINCT FROM g.predicted""",
    "metrics_class0": f"""
        SELECT round(avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
               round(coalesce(sum(CASE WHEN y = 0 AND prediction = 0 THEN 1 ELSE 0 END)
                     / nullif(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END), 0), 0.0), 6) AS precision,
               round(coalesce(sum(CASE WHEN y = 0 AND prediction = 0 THEN 1 ELSE 0 END)
                     / nullif(sum(CASE WHEN y = 0 THEN 1 ELSE 0 END), 0), 0.0), 6) AS recall
          FROM {EV_SCORED}""",
}
