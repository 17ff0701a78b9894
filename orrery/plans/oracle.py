"""DuckDB SQL oracles, one per registered query with an exact SQL form.

Written independently of the Spark code: plain global windows and joins, as a
single-node engine would run them.  Tables are the pre-registered views.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# ----------------------------------------------------------------- fragments

DOC_SCORED = """
doc_base AS (
  SELECT d.doc_id, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
),
doc_bounds AS (SELECT CAST(max(doc_id) + 1 AS DOUBLE) AS n FROM documents),
doc_split AS (
  SELECT b.*,
         CASE WHEN b.doc_id < floor(x.n * 0.8) THEN 'train'
              WHEN b.doc_id < floor(x.n * 0.9) THEN 'valid' ELSE 'test' END AS split,
         1.0 / (1.0 + exp(-(CAST(b.n_chars AS DOUBLE) / 1000.0 - 2.0))) AS p
  FROM doc_base b, doc_bounds x
),
scored AS (
  SELECT doc_id, split, 'quality' AS task, quality AS y, p FROM doc_split
  UNION ALL
  SELECT doc_id, split, 'toxic' AS task, toxic AS y, p FROM doc_split
)"""


def exact_auc_ctes(src: str, keys: str, prefix: str = "ex") -> str:
    """CTEs ``{prefix}_sc``, ``{prefix}_nb``, ``{prefix}`` computing exact AUC of ``src`` by ``keys``."""
    return f"""
{prefix}_sc AS (
  SELECT {keys}, p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
  FROM {src} GROUP BY {keys}, p
),
{prefix}_nb AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY {keys} ORDER BY p
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
  FROM {prefix}_sc
),
{prefix} AS (
  SELECT {keys},
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0
              THEN sum(pos * (neg_below + neg / 2)) / (sum(pos) * sum(neg)) END AS auc,
         CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
  FROM {prefix}_nb GROUP BY {keys}
)"""


def hist_ctes(src: str, keys: str, prefix: str = "bn", steps: int = 100) -> str:
    """CTEs ``{prefix}_h`` (histogram), ``{prefix}_c`` (curve), ``{prefix}`` (binned AUC)."""
    return f"""
{prefix}_h AS (
  SELECT {keys}, CAST(least(greatest(floor(round(p * {steps}.0, 9)), 0), {steps}) AS INTEGER) AS bin,
         CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg
  FROM {src} GROUP BY ALL
),
{prefix}_c0 AS (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER (PARTITION BY {keys}) AS n_pos, sum(neg) OVER (PARTITION BY {keys}) AS n_neg
  FROM {prefix}_h
  WINDOW w AS (PARTITION BY {keys} ORDER BY bin DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
{prefix}_c AS (
  SELECT *, lag(tp, 1, 0) OVER w2 AS tp_prev, lag(fp, 1, 0) OVER w2 AS fp_prev
  FROM {prefix}_c0 WINDOW w2 AS (PARTITION BY {keys} ORDER BY bin DESC)
),
{prefix} AS (
  SELECT {keys},
         CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0
              THEN sum(CAST(fp - fp_prev AS DOUBLE) * CAST(tp + tp_prev AS DOUBLE) / 2)
                   / (CAST(max(n_pos) AS DOUBLE) * max(n_neg)) END AS auc,
         CAST(max(n_pos) AS BIGINT) AS n_pos, CAST(max(n_neg) AS BIGINT) AS n_neg
  FROM {prefix}_c GROUP BY {keys}
)"""


ORACLE["v2_evaluate"] = f"""
WITH {DOC_SCORED},
{exact_auc_ctes("scored", "split, task")},
{hist_ctes("scored", "split, task")}
SELECT ex.split, ex.task, round(ex.auc, 6) AS auc_exact, round(bn.auc, 6) AS auc_binned, ex.n_pos, ex.n_neg
FROM ex JOIN bn ON ex.split = bn.split AND ex.task = bn.task
"""


# ------------------------------------------------------------- AUC family

ORACLE["a3_roc_histogram"] = f"""
WITH {DOC_SCORED},
{hist_ctes("scored", "split, task")}
SELECT split, task, bin, pos, neg FROM bn_h
"""

ORACLE["w1_roc_curve"] = f"""
WITH {DOC_SCORED},
{hist_ctes("scored", "split, task")}
SELECT split, task, bin, round(bin / 100.0, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(tp_prev AS BIGINT) AS tp_prev, CAST(fp_prev AS BIGINT) AS fp_prev
FROM bn_c
"""

ORACLE["a4_auc_binned"] = f"""
WITH {DOC_SCORED},
{hist_ctes("scored", "split, task")}
SELECT split, task, round(auc, 6) AS auc, n_pos, n_neg FROM bn
"""

ORACLE["a5_auc_exact"] = f"""
WITH {DOC_SCORED},
{exact_auc_ctes("scored", "split, task")}
SELECT split, task, round(auc, 6) AS auc, n_pos, n_neg FROM ex
"""

ORACLE["w2_negatives_below"] = f"""
WITH {DOC_SCORED},
{exact_auc_ctes("scored", "split, task")}
SELECT split, task, round(p, 6) AS p, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
       CAST(neg_below AS BIGINT) AS neg_below
FROM ex_nb
"""

# the rule of catalog.class_map, written out
_CLASS_SCORES = ", ".join(
    f"list_inner_product(CAST(e.embedding AS DOUBLE[]), {[((i * (c + 2) + 3 * c) % 7 - 3) / 4 for i in range(64)]}::DOUBLE[])"
    for c in range(10))

EMB_SCORED = f"""
emb_bounds AS (SELECT CAST(max(vec_id) + 1 AS DOUBLE) AS n FROM embeddings),
emb_x AS (
  SELECT e.vec_id, e.label, [{_CLASS_SCORES}] AS z,
         CASE WHEN e.vec_id < floor(b.n * 0.8) THEN 'train'
              WHEN e.vec_id < floor(b.n * 0.9) THEN 'valid' ELSE 'test' END AS split
  FROM embeddings e, emb_bounds b
),
emb_sm AS (
  SELECT vec_id, label, split,
         list_transform(z, lambda v: exp(v - list_max(z))) AS ez
  FROM emb_x
),
emb_p AS (
  SELECT vec_id, label, split, list_transform(ez, lambda v: v / list_sum(ez)) AS p FROM emb_sm
),
emb_long AS (
  SELECT vec_id, split, CAST(c - 1 AS INTEGER) AS class, CASE WHEN label = c - 1 THEN 1 ELSE 0 END AS y, p[c] AS p
  FROM emb_p, range(1, 11) r(c)
)"""

ORACLE["a6_auc_per_class"] = f"""
WITH {EMB_SCORED},
{exact_auc_ctes("emb_long", "split, class")}
SELECT split, class, round(auc, 6) AS auc, n_pos, n_neg FROM ex
"""

ORACLE["a7_auc_macro"] = f"""
WITH {EMB_SCORED},
{exact_auc_ctes("emb_long", "split, class")}
SELECT split, round(avg(auc), 6) AS auc_macro, count(auc) AS n_classes FROM ex GROUP BY split
"""

ORACLE["a8_auc_task_mean"] = f"""
WITH {DOC_SCORED},
{exact_auc_ctes("scored", "split, task")}
SELECT split, round(avg(auc), 6) AS auc_mean, count(auc) AS n_tasks,
       round(max(CASE WHEN task = 'quality' THEN auc END), 6) AS auc_quality,
       round(max(CASE WHEN task = 'toxic' THEN auc END), 6) AS auc_toxic
FROM ex GROUP BY split
"""

ORACLE["a9_mean_loss"] = f"""
WITH {DOC_SCORED},
l AS (
  SELECT split, task,
         -(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))) AS loss
  FROM scored
),
per AS (SELECT split, task, avg(loss) AS loss FROM l GROUP BY split, task)
SELECT split, task, round(loss, 6) AS mean_loss FROM per
UNION ALL
SELECT split, 'all' AS task, round(sum(loss), 6) AS mean_loss FROM per GROUP BY split
"""

EPOCH_SCORED = """
ep_base AS (
  SELECT s.doc_id, s.split, s.n_chars, s.quality, s.toxic, e.epoch
  FROM doc_split s, range(1, 6) e(epoch)
),
ep_p AS (
  SELECT doc_id, split, epoch, quality, toxic,
         1.0 / (1.0 + exp(-(CAST(n_chars AS DOUBLE) / 1000.0 - 2.0
                 + (CAST((doc_id * 7919 + epoch * 104729) % 1000 AS DOUBLE) / 1000.0 - 0.5) * epoch))) AS p
  FROM ep_base
),
ep_scored AS (
  SELECT doc_id, epoch, split, 'quality' AS task, quality AS y, p FROM ep_p
  UNION ALL
  SELECT doc_id, epoch, split, 'toxic' AS task, toxic AS y, p FROM ep_p
)"""

ORACLE["a11_best_epoch"] = f"""
WITH {DOC_SCORED},
{EPOCH_SCORED},
{exact_auc_ctes("ep_scored", "epoch, split, task")},
ranked AS (
  SELECT task, epoch, auc, row_number() OVER (PARTITION BY task ORDER BY auc DESC, epoch ASC) AS rk
  FROM ex WHERE split = 'valid' AND auc IS NOT NULL
)
SELECT r.task, CAST(r.epoch AS INTEGER) AS best_epoch, round(r.auc, 6) AS valid_auc, round(t.auc, 6) AS test_auc
FROM ranked r LEFT JOIN ex t ON t.task = r.task AND t.epoch = r.epoch AND t.split = 'test'
WHERE r.rk = 1
"""

# ------------------------------------------------------------- splits, slices

ORACLE["p1_slice_records"] = """
SELECT CASE WHEN o_orderkey < 3200 THEN 'train' WHEN o_orderkey < 3600 THEN 'valid' ELSE 'test' END AS slice,
       count(*) AS n, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id
FROM orders GROUP BY 1
"""

ORACLE["u1_stack_rows"] = """
SELECT o_orderkey AS record_id,
       CASE WHEN o_orderkey < 3200 THEN 'train' WHEN o_orderkey < 3600 THEN 'valid' ELSE 'test' END AS slice,
       round(o_totalprice, 6) AS o_totalprice
FROM orders
"""

ORACLE["p2_assign_split"] = f"""
WITH {DOC_SCORED}
SELECT doc_id, split FROM doc_split
"""

ORACLE["w3_batch_number"] = f"""
WITH {DOC_SCORED}
SELECT doc_id, split, CAST((row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 32 AS BIGINT) AS batch_no
FROM doc_split
"""

ORACLE["l1_first_records"] = """
SELECT d.doc_id, d.n_chars, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
ORDER BY d.doc_id LIMIT 10
"""

# ------------------------------------------------------------- cohort (orders x lineitem)

COHORT_VARS = ["quantity", "extendedprice", "discount", "tax"]
COHORT_SCALE = {"extendedprice": 1000.0}
STAT_NAMES = ["count", "min", "max", "mean", "std", "median", "first", "last", "slope"]


def _stats_select(keys: str, value: str = "value", ts_order: str = "(ts, tb, value)") -> str:
    return f"""{keys},
         count({value}) AS count, min({value}) AS min, max({value}) AS max, avg({value}) AS mean,
         stddev_samp({value}) AS std, median({value}) AS median,
         arg_min({value}, {ts_order}) AS first, arg_max({value}, {ts_order}) AS last,
         CASE WHEN var_pop(h) = 0 THEN NULL ELSE regr_slope({value}, h) END AS slope"""


COHORT_LONG = "\nUNION ALL\n".join(
    f"""  SELECT l_orderkey AS record_id, l_shipdate AS ts, l_linenumber AS tb,
         CAST(epoch_us(l_shipdate) AS DOUBLE) / 3600000000.0 AS h, '{v}' AS variable,
         CAST(l_{v} AS DOUBLE) / {COHORT_SCALE.get(v, 1.0)} AS value FROM lineitem"""
    for v in COHORT_VARS)

_wide_cols = ",\n  ".join(
    f"max(CASE WHEN variable = '{v}' THEN {s} END) AS {v}_{s}" for v in COHORT_VARS for s in STAT_NAMES)
_feat_items = ", ".join(
    [f"coalesce(CAST(w.{v}_{s} AS DOUBLE), 0.0)" for v in COHORT_VARS for s in STAT_NAMES]
    + [f"CASE WHEN o.o_orderpriority = '{p}' THEN 1.0 ELSE 0.0 END"
       for p in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]]
    + [f"CASE WHEN o.o_orderstatus = '{s}' THEN 1.0 ELSE 0.0 END" for s in ["F", "O", "P"]]
    + ["coalesce(o.o_totalprice / 10000.0, 0.0)"])

COHORT_FEATURES = f"""
c_long AS (
{COHORT_LONG}
),
c_stats AS (SELECT {_stats_select("record_id, variable")} FROM c_long GROUP BY record_id, variable),
c_wide AS (SELECT record_id,
  {_wide_cols}
  FROM c_stats GROUP BY record_id),
c_feat AS (
  SELECT o.o_orderkey AS record_id, list_value({_feat_items}) AS features
  FROM orders o LEFT JOIN c_wide w ON w.record_id = o.o_orderkey
)"""

ORACLE["p3_assemble_features"] = f"""
WITH {COHORT_FEATURES}
SELECT record_id, CAST(unnest(generate_series(0, len(features) - 1)) AS INTEGER) AS pos,
       round(unnest(features), 6) AS value
FROM c_feat
"""

COHORT_LABELS = """
c_lines AS (
  SELECT l_orderkey AS record_id, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS y_mortality,
         min(CAST(l_shipdate AS DATE)) AS first_ship, max(CAST(l_shipdate AS DATE)) AS last_ship
  FROM lineitem GROUP BY l_orderkey
),
c_days AS (
  SELECT c.record_id, c.y_mortality, datediff('day', c.first_ship, c.last_ship) AS los_days,
         datediff('day', CAST(o.o_orderdate AS DATE), c.first_ship) AS surv_days
  FROM c_lines c LEFT JOIN orders o ON o.o_orderkey = c.record_id
),
c_labels AS (
  SELECT record_id, CAST(y_mortality AS INTEGER) AS y_mortality,
         CAST(CASE WHEN los_days IS NULL OR los_days < 0 THEN NULL WHEN los_days < 2 THEN 0 WHEN los_days < 3 THEN 1
              WHEN los_days < 4 THEN 2 WHEN los_days < 5 THEN 3 WHEN los_days < 6 THEN 4 WHEN los_days < 7 THEN 5
              WHEN los_days <= 30 THEN 6 ELSE 7 END AS INTEGER) AS y_los,
         CAST(CASE WHEN surv_days IS NULL OR surv_days < 0 THEN 4 WHEN surv_days <= 7 THEN 0
              WHEN surv_days <= 30 THEN 1 WHEN surv_days <= 365 THEN 2 ELSE 3 END AS INTEGER) AS y_survival
  FROM c_days
)"""

ORACLE["j2_align_many"] = f"""
WITH {COHORT_LABELS}
SELECT o.o_orderkey AS record_id, round(o.o_totalprice, 6) AS o_totalprice, c.y_mortality, c.y_los, c.y_survival
FROM orders o JOIN c_labels c ON c.record_id = o.o_orderkey
"""

ORACLE["a10_dataset_summary"] = f"""
WITH {COHORT_FEATURES},
{COHORT_LABELS},
d AS (SELECT f.record_id, f.features, c.y_mortality, c.y_los, c.y_survival
      FROM c_feat f JOIN c_labels c ON c.record_id = f.record_id),
shape AS (SELECT count(*) AS n_rows, CAST(min(len(features)) AS INTEGER) AS min_width,
                 CAST(max(len(features)) AS INTEGER) AS max_width, min(record_id) AS first_record FROM d),
parts AS (
  SELECT 'y_mortality' AS target_set, y_mortality AS class, count(*) AS n_class FROM d GROUP BY 2
  UNION ALL SELECT 'y_los', y_los, count(*) FROM d GROUP BY 2
  UNION ALL SELECT 'y_survival', y_survival, count(*) FROM d GROUP BY 2
),
one AS (SELECT * FROM d ORDER BY record_id LIMIT 1)
SELECT p.target_set, CAST(p.class AS INTEGER) AS class, p.n_class, 3 AS n_target_sets,
       s.n_rows, s.min_width, s.max_width, s.first_record,
       CASE p.target_set WHEN 'y_mortality' THEN one.y_mortality WHEN 'y_los' THEN one.y_los ELSE one.y_survival END
         AS first_label,
       {", ".join(f"round(one.features[{i + 1}], 6) AS first_f{i}" for i in range(45))}
FROM parts p, shape s, one
"""

# ------------------------------------------------------------- projections

ORACLE["p4_squeeze_label"] = """
SELECT doc_id, quality, quality AS two_0, toxic AS two_1, 2 AS two_width FROM labels
"""

ORACLE["p5_select_groups"] = """
SELECT vec_id, CAST(g AS INTEGER) AS grp, CAST(i AS INTEGER) AS i,
       round(CAST(embedding[g * 8 + i + 1] AS DOUBLE), 6) AS value
FROM embeddings, range(0, 8) a(g), range(0, 8) b(i)
"""

# ------------------------------------------------------------- alignment

ORACLE["j1_align"] = """
SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def _audit(feat_sql: str, lab_sql: str, name: str) -> str:
    return f"""
SELECT '{name}' AS label_set,
       count(CASE WHEN f.n IS NOT NULL AND l.n IS NOT NULL THEN 1 END) AS matched,
       count(CASE WHEN l.n IS NULL THEN 1 END) AS missing_labels,
       count(CASE WHEN f.n IS NULL THEN 1 END) AS missing_features,
       count(CASE WHEN f.n > 1 THEN 1 END) AS dup_feature_ids,
       count(CASE WHEN l.n > 1 THEN 1 END) AS dup_label_ids
FROM (SELECT id, count(*) AS n FROM ({feat_sql}) GROUP BY id) f
FULL OUTER JOIN (SELECT id, count(*) AS n FROM ({lab_sql}) GROUP BY id) l ON f.id = l.id"""


ORACLE["j3_alignment_audit"] = (
    _audit("SELECT doc_id AS id FROM documents", "SELECT doc_id AS id FROM labels", "labels")
    + "\nUNION ALL\n"
    + _audit("SELECT o_orderkey AS id FROM orders", "SELECT l_orderkey AS id FROM lineitem", "lineitem"))

ORACLE["j4_attach_predictions"] = """
SELECT d.doc_id, round(1.0 / (1.0 + exp(-(CAST(d.n_chars AS DOUBLE) / 1000.0 - 2.0))), 6) AS p, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

# ------------------------------------------------------------- encodings

ORACLE["e1_one_hot"] = "SELECT vec_id, " + ", ".join(
    f"CAST(CASE WHEN label = {i} THEN 1 ELSE 0 END AS DOUBLE) AS oh_{i}" for i in range(10)) + " FROM embeddings"

ORACLE["e2_one_hot_nullable"] = "SELECT doc_id, " + ", ".join(
    f"CAST(CASE WHEN lang = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS lang_{v}" for v in ["en", "fr", "de"]) + " FROM documents"

LINE_DAYS = """
ld AS (
  SELECT l.l_orderkey, l.l_linenumber,
         CAST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS days
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
)"""

ORACLE["e3_los_bucket"] = f"""
WITH {LINE_DAYS}
SELECT l_orderkey, l_linenumber, days,
       CAST(CASE WHEN days IS NULL OR days < 0 THEN NULL WHEN days < 2 THEN 0 WHEN days < 3 THEN 1
            WHEN days < 4 THEN 2 WHEN days < 5 THEN 3 WHEN days < 6 THEN 4 WHEN days < 7 THEN 5
            WHEN days <= 30 THEN 6 ELSE 7 END AS INTEGER) AS los
FROM ld
"""

ORACLE["e4_survival_bucket"] = f"""
WITH {LINE_DAYS}
SELECT l_orderkey, l_linenumber, days,
       CAST(CASE WHEN days IS NULL OR days < 0 THEN 4 WHEN days <= 7 THEN 0 WHEN days <= 30 THEN 1
            WHEN days <= 365 THEN 2 ELSE 3 END AS INTEGER) AS survival
FROM ld
"""

ORACLE["e5_activations"] = """
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT vec_id, e, list_sum(list_transform(e, lambda v: exp(v - list_max(e)))) AS z, list_max(e) AS m FROM x)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS i,
       round(greatest(e[i], 0.0), 6) AS relu,
       round(1.0 / (1.0 + exp(-e[i])), 6) AS sigmoid,
       round(exp(e[i] - m) / z, 6) AS softmax
FROM s, range(1, 65) r(i)
WHERE i <= len(e)
"""

ORACLE["e6_bce"] = f"""
WITH {DOC_SCORED}
SELECT doc_id, task,
       round(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))), 6)
         AS loss
FROM scored
"""

ORACLE["e6_cce"] = f"""
WITH {EMB_SCORED}
SELECT vec_id, round(-ln(least(greatest(p[label + 1], 1e-7), 1 - 1e-7)), 6) AS loss FROM emb_p
"""

# ------------------------------------------------------------- statistics on events

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

EVENT_STATS = f"""
ev AS (SELECT *, CAST(epoch_us(ts) AS DOUBLE) / 3600000000.0 AS h FROM events),
ev_stats AS (SELECT {_stats_select("user_id, event_type", ts_order="(ts, event_id, value)")}
             FROM ev GROUP BY user_id, event_type)"""

ORACLE["a1_variable_stats"] = f"""
WITH {EVENT_STATS}
SELECT user_id, event_type, count, """ + ", ".join(f"round({s}, 6) AS {s}" for s in STAT_NAMES[1:]) + """
FROM ev_stats
"""

ORACLE["a2_stats_wide"] = f"""
WITH {EVENT_STATS}
SELECT user_id, """ + ",\n  ".join(
    (f"coalesce(max(CASE WHEN event_type = '{v}' THEN count END), 0) AS {v}_{s}" if s == "count"
     else f"round(max(CASE WHEN event_type = '{v}' THEN {s} END), 6) AS {v}_{s}")
    for v in EVENT_TYPES for s in STAT_NAMES) + """
FROM ev_stats GROUP BY user_id
"""

# ------------------------------------------------------------- sources (files exported by Spark, read back)

_EMB_FLAT = ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS f{i}" for i in range(64))
ORACLE["s1_read_numbered_csv"] = f"SELECT vec_id AS record_id, {_EMB_FLAT} FROM embeddings"
ORACLE["s5_compact"] = ORACLE["s1_read_numbered_csv"]
ORACLE["s2_read_csv_dir"] = """
SELECT doc_id AS record_id, round(CAST(quality AS DOUBLE), 6) AS c0, round(CAST(toxic AS DOUBLE), 6) AS c1 FROM labels
"""
ORACLE["s3_read_sequences"] = """
SELECT user_id AS record_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS step,
       round(value, 6) AS value, round(CAST(epoch_us(ts) AS DOUBLE) / 3600000000.0, 6) AS hour
FROM events
"""
_ALL64 = ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS f{i}" for i in range(64))
ORACLE["s4_read_dataset"] = f"""
SELECT vec_id AS record_id, CAST(label AS DOUBLE) AS y_label, CAST(CASE WHEN label >= 5 THEN 1 ELSE 0 END AS DOUBLE) AS y_high,
       CAST(len(embedding) AS INTEGER) AS width, {_ALL64}
FROM embeddings
"""
ORACLE["e7_parse_numeric"] = """
WITH f AS (SELECT vec_id, vec_id % 7 = 3 OR vec_id % 11 = 5 OR vec_id % 13 = 6 AS bad, vec_id % 7 = 3 AS empty,
                  list_sum([CAST(x AS DOUBLE) for x in embedding]) AS total FROM embeddings)
SELECT count(*) AS n_rows, count(*) FILTER (NOT bad) AS n_good_rows, count(*) FILTER (empty) AS n_empty_fields,
       count(*) FILTER (bad AND NOT empty) AS n_bad_fields, round(sum(total) FILTER (NOT bad), 4) AS good_total FROM f
"""

# ------------------------------------------------------------- fixed small net on embeddings


def _fixed_net_sql() -> str:
    from .catalog import fixed_weights
    w1, b1, w_bin, b_bin, w_cls, b_cls = fixed_weights()
    h = ", ".join(f"greatest(list_inner_product(x, {row}::DOUBLE[]) + {b}, 0.0)" for row, b in zip(w1, b1))
    zb = f"list_inner_product(h, {w_bin[0]}::DOUBLE[]) + {b_bin[0]}"
    zc = [f"(list_inner_product(h, {row}::DOUBLE[]) + {b})" for row, b in zip(w_cls, b_cls)]
    return f"""
WITH x AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
hh AS (SELECT vec_id, list_value({h}) AS h FROM x),
z AS (SELECT vec_id, {zb} AS zb, {zc[0]} AS z0, {zc[1]} AS z1, {zc[2]} AS z2 FROM hh),
m AS (SELECT *, greatest(z0, z1, z2) AS zm FROM z)
SELECT vec_id, round(1.0 / (1.0 + exp(-zb)), 6) AS p_bin,
       round(exp(z0 - zm) / (exp(z0 - zm) + exp(z1 - zm) + exp(z2 - zm)), 6) AS p_c0,
       round(exp(z1 - zm) / (exp(z0 - zm) + exp(z1 - zm) + exp(z2 - zm)), 6) AS p_c1,
       round(exp(z2 - zm) / (exp(z0 - zm) + exp(z1 - zm) + exp(z2 - zm)), 6) AS p_c2
FROM m
"""


ORACLE["e8_dense_forward"] = _fixed_net_sql()
ORACLE["v1_predict"] = ORACLE["e8_dense_forward"]
ORACLE["s7_model_roundtrip"] = ORACLE["e8_dense_forward"]

# ------------------------------------------------------------- gradients and reports of the fixed net


def _planted_ctes() -> str:
    """``r``: a row for each vector with labels, split, hidden values, probabilities of both heads."""
    from .catalog import fixed_weights
    w1, b1, w_bin, b_bin, w_cls, b_cls = fixed_weights()
    z = ", ".join(f"list_inner_product(x, {row}::DOUBLE[]) + {b}" for row, b in zip(w1, b1))
    zc = ", ".join(f"list_inner_product(h, {row}::DOUBLE[]) + {b}" for row, b in zip(w_cls, b_cls))
    return f"""
px AS (SELECT e.vec_id, CAST(e.embedding AS DOUBLE[]) AS x, CASE WHEN e.label >= 5 THEN 1 ELSE 0 END AS y_bin,
              CAST(e.label % 3 AS INTEGER) AS y_cls,
              CASE WHEN e.vec_id < floor(b.n * 0.8) THEN 'train' WHEN e.vec_id < floor(b.n * 0.9) THEN 'valid'
                   ELSE 'test' END AS split
       FROM embeddings e, (SELECT CAST(max(vec_id) + 1 AS DOUBLE) AS n FROM embeddings) b),
pz AS (SELECT *, [{z}] AS z FROM px),
ph AS (SELECT *, [greatest(v, 0.0) for v in z] AS h FROM pz),
pc AS (SELECT *, list_inner_product(h, {w_bin[0]}::DOUBLE[]) + {b_bin[0]} AS zb, [{zc}] AS zc FROM ph),
pe AS (SELECT *, [exp(v - list_max(zc)) for v in zc] AS ec FROM pc),
r AS (SELECT *, 1.0 / (1.0 + exp(-zb)) AS p_bin, [v / list_sum(ec) for v in ec] AS p_cls FROM pe)"""


def _gradient_sql(bin_: bool, cls: bool) -> str:
    from .catalog import fixed_weights
    _, _, w_bin, _, w_cls, _ = fixed_weights()
    dh = ", ".join("({} {})".format(f"db * {w_bin[0][j]}" if bin_ else "0.0",
                                    "".join(f" + dc[{k + 1}] * {w_cls[k][j]}" for k in range(3)) if cls else "")
                   + f" * CASE WHEN z[{j + 1}] > 0 THEN 1 ELSE 0 END" for j in range(4))
    parts = ["SELECT 'W1' AS param, i * 4 + j AS i, sum(x[i + 1] * dz[j + 1]) AS g FROM d, range(64) a(i), range(4) b(j) GROUP BY 1, 2",
             "SELECT 'b1', j, sum(dz[j + 1]) FROM d, range(4) b(j) GROUP BY 1, 2"]
    if bin_:
        parts += ["SELECT 'W_bin', j, sum(h[j + 1] * db) FROM d, range(4) b(j) GROUP BY 1, 2",
                  "SELECT 'b_bin', 0, sum(db) FROM d"]
    if cls:
        parts += ["SELECT 'W_cls', j * 3 + k, sum(h[j + 1] * dc[k + 1]) FROM d, range(4) b(j), range(3) c(k) GROUP BY 1, 2",
                  "SELECT 'b_cls', k, sum(dc[k + 1]) FROM d, range(3) c(k) GROUP BY 1, 2"]
    return f"""
WITH {_planted_ctes()},
e AS (SELECT *, p_bin - y_bin AS db, [p_cls[k + 1] - CASE WHEN y_cls = k THEN 1 ELSE 0 END for k in range(3)] AS dc FROM r),
d AS (SELECT *, [{dh}] AS dz FROM e)
SELECT param, CAST(i AS INTEGER) AS i, round(g, 4) AS gradient FROM ({" UNION ALL ".join(parts)})
"""


ORACLE["m3_gradient"] = _gradient_sql(True, False)
ORACLE["m4_gradient"] = _gradient_sql(False, True)
ORACLE["m5_gradient"] = _gradient_sql(True, True)

_PLANTED_LONG = f"""{_planted_ctes()},
long AS (SELECT split, 'bin' AS task, 0 AS class, y_bin AS y, p_bin AS p FROM r
         UNION ALL SELECT split, 'cls', CAST(k AS INTEGER), CASE WHEN y_cls = k THEN 1 ELSE 0 END, p_cls[k + 1]
         FROM r, range(3) c(k)),
losses AS (SELECT split, 'bin' AS task,
                  avg(-ln(greatest(least(CASE WHEN y_bin = 1 THEN p_bin ELSE 1 - p_bin END, 1 - 1e-7), 1e-7))) AS loss,
                  count(*) AS rows FROM r GROUP BY split
           UNION ALL SELECT split, 'cls', avg(-ln(greatest(least(p_cls[y_cls + 1], 1 - 1e-7), 1e-7))), count(*)
           FROM r GROUP BY split),
{exact_auc_ctes("long", "split, task, class", "lx")},
{hist_ctes("long", "split, task, class", "lb")},
tasks AS (SELECT lx.split, lx.task, avg(lx.auc) AS auc_exact, avg(lb.auc) AS auc_binned, count(lx.auc) AS n_classes
          FROM lx JOIN lb ON lx.split = lb.split AND lx.task = lb.task AND lx.class = lb.class GROUP BY lx.split, lx.task)"""

ORACLE["v3_evaluate_fixed"] = f"""
WITH {_PLANTED_LONG}
SELECT split, task, round(auc_binned, 6) AS auc, n_classes, round(loss, 6) AS loss, rows
FROM tasks JOIN losses USING (split, task) WHERE split IN ('train', 'valid')
"""
ORACLE["v4_report_fixed"] = f"""
WITH {_PLANTED_LONG}
SELECT split, task, round(auc_exact, 6) AS auc_exact, round(auc_binned, 6) AS auc_binned, n_classes,
       round(loss, 6) AS loss, rows
FROM tasks JOIN losses USING (split, task) WHERE split IN ('train', 'test')
"""

# ------------------------------------------------------------- runs: what does not depend on the weights

_SPLIT_OF = """CASE WHEN {id} < floor(b.n * 0.8) THEN 'train' WHEN {id} < floor(b.n * 0.9) THEN 'valid' ELSE 'test' END"""

ORACLE["t1_history"] = f"""
WITH {COHORT_LABELS},
b AS (SELECT CAST(max(o_orderkey) + 1 AS DOUBLE) AS n FROM orders),
train AS (SELECT count(*) AS n FROM orders o JOIN c_labels c ON c.record_id = o.o_orderkey, b
          WHERE o.o_orderkey < floor(b.n * 0.8))
SELECT CAST(epoch AS INTEGER) AS epoch, CAST(8 AS BIGINT) AS shards, CAST(train.n AS BIGINT) AS rows,
       CAST(0 AS BIGINT) AS missing, 1 AS sound
FROM train, range(20) e(epoch)
"""

ORACLE["s6_write_metrics"] = f"""
WITH {DOC_SCORED},
{EPOCH_SCORED},
ep_round AS (SELECT * REPLACE (round(p, 9) AS p) FROM ep_scored),
{exact_auc_ctes("ep_round", "epoch, split, task")},
ls AS (SELECT epoch, split, task, count(*) AS rows,
              avg(-ln(greatest(least(CASE WHEN y = 1 THEN p ELSE 1 - p END, 1 - 1e-7), 1e-7))) AS loss
       FROM ep_round GROUP BY epoch, split, task)
SELECT run_id, CAST(ex.epoch AS INTEGER) AS epoch, split, task, 0 AS class, round(auc, 6) AS auc, round(loss, 6) AS loss,
       rows, CAST(ex.epoch AS DOUBLE) * 1.5 AS seconds
FROM ex JOIN ls USING (epoch, split, task), (VALUES ('first'), ('second')) r(run_id)
"""

_LINEAR = f"""
lx AS (SELECT e.vec_id, {_SPLIT_OF.format(id="e.vec_id")} AS split,
              CASE WHEN list_inner_product(CAST(e.embedding AS DOUBLE[]),
                        [((i * 2) % 7 - 3) / 4.0 for i in range(64)]::DOUBLE[]) > 0 THEN 1 ELSE 0 END AS y
       FROM embeddings e, (SELECT CAST(max(vec_id) + 1 AS DOUBLE) AS n FROM embeddings) b)"""
ORACLE["m7_grid_planted"] = """
SELECT 't' AS task, CAST(4 AS BIGINT) AS n_configs, CAST(12 AS BIGINT) AS n_epochs, CAST(4 * 12 * 2 AS BIGINT) AS n_metrics,
       1 AS is_best, 1 AS learned
"""
ORACLE["m6_builtin_planted"] = f"""
WITH {_LINEAR}
SELECT split, count(*) AS rows, CAST(sum(y) AS BIGINT) AS n_pos, 1 AS learned FROM lx GROUP BY split
"""

ORACLE["program_run"] = f"""
WITH px AS (SELECT e.label, {_SPLIT_OF.format(id="e.vec_id")} AS split
            FROM embeddings e, (SELECT CAST(max(vec_id) + 1 AS DOUBLE) AS n FROM embeddings) b),
long AS (SELECT split, 'mortality' AS task, 0 AS class, label >= 5 AS hit FROM px
         UNION ALL SELECT split, 'los_bucket', k, label % 8 = k FROM px, range(8) c(k)
         UNION ALL SELECT split, 'survival_bucket', k, label % 5 = k FROM px, range(5) c(k)),
per AS (SELECT split, task, class, count(*) AS rows, bool_or(hit) AND bool_or(NOT hit) AS two_sided FROM long GROUP BY ALL)
SELECT split, task, max(rows) AS rows, count(*) FILTER (two_sided) AS n_classes, CAST(3 AS BIGINT) AS epochs,
       CAST(6 AS BIGINT) AS n_metrics, 1 AS sound
FROM per WHERE split IN ('train', 'test') GROUP BY split, task
"""

ORACLE["j2_align_landed"] = ORACLE["j2_align_many"]
ORACLE["s4_sequence_dataset"] = """
WITH per AS (SELECT user_id, CAST(count(*) % 3 AS DOUBLE) AS y_many, CAST(max(event_id) % 2 AS DOUBLE) AS y_last
             FROM events GROUP BY user_id)
SELECT e.user_id AS record_id,
       CAST(row_number() OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) - 1 AS INTEGER) AS step,
       round(e.value, 6) AS value, round(CAST(epoch_us(e.ts) AS DOUBLE) / 3600000000.0, 6) AS hour, per.y_many, per.y_last,
       CASE WHEN e.user_id = (SELECT min(user_id) FROM events) THEN 1 ELSE 0 END AS is_first
FROM events e JOIN per ON per.user_id = e.user_id
"""

# ------------------------------------------------------------- streaming forms
ORACLE["s5_land_stream"] = ORACLE["s1_read_numbered_csv"]
ORACLE["a3_roc_histogram_stream"] = ORACLE["a3_roc_histogram"]
