"""Oracle SQL (DuckDB dialect) for the registered queries, over the driver's
views. Built from shared CTE blocks so every query restates the fixture the
same way; computed doubles are rounded to 6 places, integers are BIGINT."""
from __future__ import annotations

from driftline.functions.columns import SCORE_BAND_INNER_EDGES
from driftline.operators.quantile import bin_probabilities
from driftline.operators.decision import COOLDOWN_MSG, HOLD_MSG, RECAL_MSG, RETRAIN_MSG
from driftline.operators.ksexact import EXACT_ROWS
from driftline.operators.gate import PROMOTE, REJECT
from driftline.operators.recalibrate import f1_rule, recall_rule, sweep_thresholds
from driftline.plans.policy import FIXTURE_POLICY as FP
from driftline.plans.policy import OVERLAYS, Policy, for_env, policy_fields
from driftline.plans.views import CONCEPT_MONTHS, COVARIATE_MONTHS, EVENTS_REFERENCE_END, TXN_FEATURES

T = 0.8


def _dbl(x: float) -> str:
    if x == float("inf"):
        return "CAST('inf' AS DOUBLE)"
    if x == float("-inf"):
        return "CAST('-inf' AS DOUBLE)"
    return f"CAST('{x!r}' AS DOUBLE)"


def _list(xs) -> str:
    return "[" + ", ".join(_dbl(x) for x in xs) + "]"


def _in(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


PROBS = _list(bin_probabilities(10) + [0.01, 0.50, 0.99])
FIDX = "CASE feature " + " ".join(f"WHEN '{f}' THEN {i}" for i, f in enumerate(TXN_FEATURES)) + " END"
BAND = "(" + " + ".join(f"CASE WHEN score >= {_dbl(e)} THEN 1 ELSE 0 END" for e in SCORE_BAND_INNER_EDGES) + ")"

TXN = f"""
txn_base AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
         CAST(l_shipdate AS TIMESTAMP) AS event_time,
         strftime(CAST(l_shipdate AS TIMESTAMP), '%Y-%m') AS batch_id,
         CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
         CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax,
         round((l_quantity / 50) * 0.5 + (l_discount / 0.10) * 0.3 + (l_tax / 0.08) * 0.2, 4) AS score,
         (l_orderkey * 31 + l_linenumber * 17 + l_partkey * 7) % 1000 AS h
  FROM lineitem),
txn0 AS (
  SELECT row_id, event_time, batch_id,
    CASE WHEN batch_id IN {_in(COVARIATE_MONTHS)} THEN l_quantity * 1.525 + 21.645 ELSE l_quantity END AS l_quantity,
    CASE WHEN batch_id IN {_in(COVARIATE_MONTHS)} THEN l_extendedprice * 2 ELSE l_extendedprice END AS l_extendedprice,
    l_discount, l_tax, score,
    CASE WHEN batch_id IN {_in(CONCEPT_MONTHS)} THEN (CASE WHEN h < 48 THEN 1 ELSE 0 END)
         WHEN h < (CASE WHEN score >= 0.8 THEN 900 ELSE 3 END) THEN 1 ELSE 0 END AS label, h
  FROM txn_base),
txn AS (SELECT *, round(score * 0.95, 5) AS score2,
        round(CASE WHEN label = 1 THEN least(1.0, score + 0.05) ELSE score END, 4) AS score3 FROM txn0),
ref AS (SELECT * FROM txn WHERE event_time < TIMESTAMP '2000-01-01'),
win AS (SELECT * FROM txn WHERE event_time >= TIMESTAMP '2000-01-01')"""


def _long(src: str, ids: str, feats=TXN_FEATURES) -> str:
    return " UNION ALL ".join(f"SELECT {ids}'{f}' AS feature, {f} AS value FROM {src}" for f in feats)


def _edges(ref_long: str = "ref_long", bins: int = 10) -> str:
    return f"""
qs AS (SELECT feature, count(*) AS n, quantile_cont(value, {PROBS}) AS q
       FROM {ref_long} WHERE isfinite(value) GROUP BY feature),
qd AS (SELECT *, list_sort(list_distinct(q[1:{bins + 1}])) AS u FROM qs),
edges AS (SELECT feature, n, q, CASE WHEN len(u) < 2 THEN CAST([] AS DOUBLE[])
                                     ELSE u[2:len(u) - 1] END AS inner_edges FROM qd)"""


def _drift_core(fidx: str, n_tests: int) -> str:
    """Drift CTEs over ``ref_long`` (feature, value) and ``win_long``
    (batch_id, feature, value)."""
    return f"""{_edges()},
wstat AS (SELECT batch_id, feature, count(*) FILTER (WHERE isfinite(value)) AS nf,
                 avg(value) FILTER (WHERE NOT isnan(value)) AS current_mean
          FROM win_long GROUP BY ALL),
wbin AS (SELECT w.batch_id, w.feature, len(list_filter(e.inner_edges, lambda x: x <= w.value)) AS bin,
                count(*) AS c
         FROM win_long w JOIN edges e USING (feature) WHERE isfinite(w.value) GROUP BY ALL),
rbin AS (SELECT r.feature, len(list_filter(e.inner_edges, lambda x: x <= r.value)) AS bin, count(*) AS c
         FROM ref_long r JOIN edges e USING (feature) WHERE isfinite(r.value) GROUP BY ALL),
grid AS (SELECT s.batch_id, s.feature, s.nf, e.n, unnest(range(len(e.inner_edges) + 1)) AS bin
         FROM wstat s JOIN edges e USING (feature)),
shares AS (SELECT g.batch_id, g.feature, g.bin,
                  CASE WHEN g.nf > 0 THEN coalesce(wb.c, 0) / g.nf END AS a, coalesce(rb.c, 0) / g.n AS e
           FROM grid g LEFT JOIN wbin wb USING (batch_id, feature, bin) LEFT JOIN rbin rb USING (feature, bin)),
psi AS (SELECT batch_id, feature,
               sum(CASE WHEN a IS NULL THEN NULL ELSE (greatest(a, 1e-6) - greatest(e, 1e-6))
                        * ln(greatest(a, 1e-6) / greatest(e, 1e-6)) END) AS psi
        FROM shares GROUP BY ALL),
rmom AS (SELECT feature, avg(value) AS reference_mean, stddev_pop(value) AS ref_std
         FROM ref_long WHERE isfinite(value) GROUP BY feature),
ks_u AS (SELECT b.batch_id, r.feature, r.value, 1 AS is_ref
         FROM (SELECT DISTINCT batch_id FROM win_long) b, ref_long r WHERE isfinite(r.value)
         UNION ALL SELECT batch_id, feature, value, 0 FROM win_long WHERE isfinite(value)),
ks_c AS (SELECT batch_id, feature, value, sum(is_ref) AS nr_v, sum(1 - is_ref) AS nb_v FROM ks_u GROUP BY ALL),
ks_cum AS (SELECT *, sum(nr_v) OVER w AS cr, sum(nb_v) OVER w AS cb,
                  sum(nr_v) OVER (PARTITION BY batch_id, feature) AS nr,
                  sum(nb_v) OVER (PARTITION BY batch_id, feature) AS nb
           FROM ks_c WINDOW w AS (PARTITION BY batch_id, feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
ks AS (SELECT batch_id, feature, max(abs(cr / nr - cb / nb)) AS d, max(nr) AS nr, max(nb) AS nb
       FROM ks_cum GROUP BY ALL),
ksp AS (SELECT batch_id, feature, d, nr, nb, round(nr * nb / (nr + nb)) AS en FROM ks),
ksz AS (SELECT *, sqrt(en) * d AS z FROM ksp),
kszc AS (SELECT *, z + 1.0 / (6.0 * sqrt(en)) + (z - 1) / (4.0 * en) AS zc FROM ksz),
exact AS (WITH RECURSIVE walk AS (
    SELECT batch_id, feature, CAST(least(nr, nb) AS BIGINT) AS a, CAST(greatest(nr, nb) AS BIGINT) AS c,
           CAST(round(d * nr * nb) AS BIGINT) AS far, CAST(0 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS p,
           list_transform(range(CAST(least(nr, nb) AS BIGINT) + 1), lambda i: CAST(CASE WHEN i = 0 THEN 1 ELSE 0 END AS DOUBLE)) AS q
    FROM ks WHERE greatest(nr, nb) <= {EXACT_ROWS} AND isfinite(d)
    UNION ALL
    SELECT batch_id, feature, a, c, far, t + 1,
           p + list_sum(list_transform(s, lambda x, k: CASE WHEN abs((k - 1) * (a + c) - (t + 1) * a) >= far THEN x ELSE 0 END)),
           list_transform(s, lambda x, k: CASE WHEN abs((k - 1) * (a + c) - (t + 1) * a) >= far THEN 0 ELSE x END)
    FROM (SELECT *, list_transform(q, lambda x, k: x * (c - t + k - 1) / (a + c - t)
                  + CASE WHEN k > 1 THEN q[k - 1] * (a - k + 2) / (a + c - t) ELSE 0 END) AS s FROM walk WHERE t < a + c))
  SELECT batch_id, feature, CASE WHEN far <= 0 THEN 1.0 ELSE least(1.0, p) END AS p FROM walk WHERE t = a + c),
kspv AS (SELECT batch_id, feature, d AS ks_statistic,
                CASE WHEN e.p IS NOT NULL THEN e.p WHEN zc < 0.2 THEN 1.0 ELSE least(greatest(2.0 * (
                    SELECT sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * zc * zc)) FROM range(1, 101) r(k)),
                    0.0), 1.0) END AS ks_pvalue
         FROM kszc LEFT JOIN exact e USING (batch_id, feature)),
fd AS (SELECT p.batch_id, p.feature, {fidx} AS feature_index, p.psi,
              CASE WHEN p.psi IS NULL OR NOT isfinite(p.psi) THEN 'UNKNOWN' WHEN p.psi >= 0.25 THEN 'ALERT'
                   WHEN p.psi >= 0.1 THEN 'WARN' ELSE 'OK' END AS psi_level,
              k.ks_statistic, k.ks_pvalue,
              coalesce(isfinite(k.ks_pvalue) AND k.ks_pvalue < 0.01 / {n_tests}, false) AS ks_significant,
              m.reference_mean, s.current_mean,
              (s.current_mean - m.reference_mean) / (CASE WHEN m.ref_std = 0 THEN 1e-6 ELSE m.ref_std END)
                  AS mean_shift_in_ref_sds
       FROM psi p JOIN wstat s USING (batch_id, feature) JOIN rmom m USING (feature)
       LEFT JOIN kspv k USING (batch_id, feature))"""


DRIFT = f"""{TXN},
ref_long AS ({_long('ref', '')}),
win_long AS ({_long('win', 'batch_id, ')}),""" + _drift_core(FIDX, len(TXN_FEATURES))

WIDE = """emb AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'reference' ELSE 'current' END AS batch_id,
                    unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings),
ref_long AS (SELECT printf('d%02d', pos - 1) AS feature, CAST(v AS DOUBLE) AS value FROM emb
             WHERE batch_id = 'reference'),
win_long AS (SELECT batch_id, printf('d%02d', pos - 1) AS feature, CAST(v AS DOUBLE) AS value FROM emb
             WHERE batch_id = 'current'),""" + _drift_core("CAST(substr(feature, 2) AS INTEGER)", 64)

SUMMARY = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY
              CASE WHEN isfinite(psi) THEN -psi ELSE 0.0 END, feature_index) AS rk FROM fd),
dsum AS (SELECT batch_id, count(*) AS n_features_tested,
                count(*) FILTER (WHERE psi_level = 'ALERT') AS n_features_alert,
                count(*) FILTER (WHERE psi_level = 'WARN') AS n_features_warn,
                count(*) FILTER (WHERE ks_significant) AS n_ks_significant,
                count(*) FILTER (WHERE psi_level = 'ALERT') / greatest(count(*), 1) AS drifted_fraction,
                max(psi) FILTER (WHERE isfinite(psi)) AS max_psi
         FROM fd GROUP BY batch_id)"""

REF_MODEL = f"""
rband AS (SELECT {BAND} AS band, count(*) AS c FROM ref WHERE isfinite(score) GROUP BY ALL),
rmodel AS (SELECT count(*) AS n_scores, avg(score) AS mean_score,
                  avg(CASE WHEN score >= {T} THEN 1.0 ELSE 0.0 END) AS flag_rate,
                  count(*) FILTER (WHERE isfinite(score)) AS nfin, avg(label) AS reference_fraud_rate
           FROM ref),
rbands AS (SELECT b.band, greatest(coalesce(rb.c, 0) / m.nfin, 0.5 / greatest(m.n_scores, 1)) AS expected
           FROM (SELECT unnest(range(10)) AS band) b LEFT JOIN rband rb USING (band), rmodel m)"""


def _perf(src: str, key: str, thr: str = f"{T}", name: str = "pm") -> str:
    """Threshold and ranking metrics per ``key`` over labelled rows of ``src``
    (columns key, score, label)."""
    return f"""
{name}_g AS (SELECT {key}, score, count(*) AS n, sum(label) AS k FROM {src}
             WHERE label IS NOT NULL GROUP BY ALL),
{name}_t AS (SELECT {key}, sum(n) AS n_rows, sum(k) AS n_frauds,
             sum(CASE WHEN score >= {thr} THEN k ELSE 0 END) AS tp,
             sum(CASE WHEN score >= {thr} THEN n - k ELSE 0 END) AS fp,
             sum(CASE WHEN score >= {thr} THEN 0 ELSE k END) AS fn,
             sum(CASE WHEN score >= {thr} THEN 0 ELSE n - k END) AS tn FROM {name}_g GROUP BY ALL),
{name}_r AS (SELECT {key}, score, n, k, sum(n) OVER w AS cum_n, sum(k) OVER w AS cum_k FROM {name}_g
             WHERE isfinite(score)
             WINDOW w AS (PARTITION BY {key} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
{name}_a AS (SELECT {key}, sum(k) AS P, sum(n - k) AS N, sum(k * cum_k / cum_n) AS ap_num,
             sum(k * (cum_n - cum_k)) AS kcn, sum(k * (n - k)) AS kn FROM {name}_r GROUP BY ALL),
{name} AS (SELECT t.{key}, t.n_rows, t.n_frauds, t.n_frauds / t.n_rows AS fraud_rate,
           t.tp, t.fp, t.fn, t.tn,
           coalesce(t.tp / nullif(t.tp + t.fp, 0), 0.0) AS precision,
           coalesce(t.tp / nullif(t.tp + t.fn, 0), 0.0) AS recall,
           t.tp + t.fp AS alert_volume, coalesce(t.fp / nullif(t.fp + t.tp, 0), 0.0) AS false_discovery_rate,
           t.fn AS missed_fraud_count,
           CASE WHEN a.P > 0 AND a.N > 0 THEN a.ap_num / a.P END AS pr_auc,
           CASE WHEN a.P > 0 AND a.N > 0 THEN (a.P * a.N - a.kcn + 0.5 * a.kn) / (a.P * a.N) END AS roc_auc
           FROM {name}_t t LEFT JOIN {name}_a a USING ({key})),
{name}_f1 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
              ELSE 0.0 END AS f1 FROM {name})"""


def _report(p: Policy, env_col: str = "") -> str:
    """Per-window report + baseline comparison under policy ``p``."""
    return f"""{DRIFT},{SUMMARY},{REF_MODEL},{_perf('win', 'batch_id')},{_perf('ref', 'row_one', name='bm').replace('SELECT row_one', 'SELECT row_one').replace('FROM ref', 'FROM (SELECT 1 AS row_one, * FROM ref)')},
wb AS (SELECT batch_id, {BAND} AS band, count(*) FILTER (WHERE isfinite(score)) AS c FROM win GROUP BY ALL),
wtot AS (SELECT batch_id, count(*) AS n_rows, count(*) FILTER (WHERE isfinite(score)) AS nfin,
                avg(CASE WHEN score >= {T} AND NOT isnan(score) THEN 1.0 ELSE 0.0 END) AS flag_rate,
                avg(score) FILTER (WHERE NOT isnan(score)) AS mean_score FROM win GROUP BY ALL),
wband AS (SELECT t.batch_id, b.band, CASE WHEN t.nfin > 0 THEN coalesce(wb.c, 0) / t.nfin END AS a, b.expected AS e
          FROM wtot t CROSS JOIN rbands b LEFT JOIN wb ON wb.batch_id = t.batch_id AND wb.band = b.band),
spsi AS (SELECT batch_id, sum(CASE WHEN a IS NULL THEN NULL ELSE (greatest(a, 1e-6) - greatest(e, 1e-6))
                 * ln(greatest(a, 1e-6) / greatest(e, 1e-6)) END) AS score_psi FROM wband GROUP BY ALL),
pred AS (SELECT t.batch_id, t.n_rows, s.score_psi, t.mean_score, t.flag_rate, m.flag_rate AS reference_flag_rate,
                m.mean_score AS reference_mean_score,
                CASE WHEN m.flag_rate > 0 THEN abs(t.flag_rate - m.flag_rate) / m.flag_rate END
                    AS flag_rate_relative_change
         FROM wtot t JOIN spsi s USING (batch_id), rmodel m),
base AS (SELECT pr_auc AS base_pr_auc, recall AS base_recall, precision AS base_precision FROM bm_f1),
perf AS (SELECT p.batch_id, coalesce(q.n_rows, 0) AS n_labeled,
                {', '.join(f"CASE WHEN q.n_rows >= {p.min_labeled_rows} THEN q.{c} END AS {c}" for c in
                           ("n_frauds", "pr_auc", "roc_auc", "recall", "precision", "fp", "missed_fraud_count"))},
                CASE WHEN coalesce(q.n_rows, 0) < {p.min_labeled_rows} THEN 'INSUFFICIENT'
                     WHEN coalesce(q.n_frauds, 0) < {p.min_labeled_frauds} THEN 'INSUFFICIENT'
                     ELSE 'OK' END AS perf_status
         FROM pred p LEFT JOIN pm_f1 q USING (batch_id)),
rep AS (SELECT p.*, d.n_features_tested, d.n_features_alert, d.n_features_warn, d.n_ks_significant, d.drifted_fraction, d.max_psi,
               f.perf_status, f.n_labeled, f.n_frauds, f.pr_auc, f.roc_auc, f.recall, f.precision, f.fp,
               f.missed_fraud_count, b.base_pr_auc, b.base_recall, b.base_precision,
               CASE WHEN f.perf_status = 'OK' AND f.pr_auc IS NOT NULL AND b.base_pr_auc IS NOT NULL
                         AND b.base_pr_auc <> 0 THEN (b.base_pr_auc - f.pr_auc) / b.base_pr_auc END
                   AS pr_auc_relative_drop,
               CASE WHEN f.perf_status = 'OK' THEN b.base_recall - f.recall END AS recall_absolute_drop,
               CASE WHEN f.perf_status = 'OK' THEN b.base_precision - f.precision END AS precision_absolute_drop
        FROM pred p LEFT JOIN dsum d USING (batch_id) JOIN perf f USING (batch_id), base b)"""


def _signals(p: Policy) -> str:
    return f"""
sig AS (
  SELECT batch_id, 0 AS o, 'batch_size' AS name, 'ALERT' AS level, CAST(n_rows AS DOUBLE) AS value,
         CAST({p.min_batch_rows} AS DOUBLE) AS threshold, 'data_quality' AS category
  FROM rep WHERE n_rows < {p.min_batch_rows}
  UNION ALL
  SELECT batch_id, 2, 'dataset_drift_breadth',
         CASE WHEN drifted_fraction >= {p.drifted_fraction_alert} THEN 'ALERT'
              WHEN drifted_fraction >= {p.drifted_fraction_warn} THEN 'WARN' ELSE 'OK' END,
         drifted_fraction, {p.drifted_fraction_warn}, 'drift' FROM rep
  UNION ALL
  SELECT batch_id, 3, 'max_feature_psi', 'WARN', max_psi, {p.psi_alert}, 'drift' FROM rep
  WHERE isfinite(max_psi) AND max_psi >= {p.psi_alert}
  UNION ALL
  SELECT batch_id, 4, 'score_distribution_psi',
         CASE WHEN NOT isfinite(score_psi) THEN 'OK' WHEN score_psi >= {p.score_psi_alert} THEN 'ALERT'
              WHEN score_psi >= {p.score_psi_warn} THEN 'WARN' ELSE 'OK' END,
         score_psi, {p.score_psi_warn}, 'prediction' FROM rep
  UNION ALL
  SELECT batch_id, 5, 'flag_rate_shift',
         CASE WHEN flag_rate_relative_change >= {p.flag_rate_rel_alert} THEN 'ALERT'
              WHEN flag_rate_relative_change >= {p.flag_rate_rel_warn} THEN 'WARN' ELSE 'OK' END,
         flag_rate_relative_change, {p.flag_rate_rel_warn}, 'prediction' FROM rep
  WHERE isfinite(flag_rate_relative_change)
  UNION ALL
  SELECT batch_id, 6, 'performance_availability', 'OK', NULL, NULL, 'performance' FROM rep
  WHERE perf_status <> 'OK'
  UNION ALL
  SELECT batch_id, 7, 'pr_auc_degradation',
         CASE WHEN pr_auc_relative_drop >= {p.pr_auc_rel_alert} THEN 'ALERT'
              WHEN pr_auc_relative_drop >= {p.pr_auc_rel_warn} THEN 'WARN' ELSE 'OK' END,
         pr_auc_relative_drop, {p.pr_auc_rel_warn}, 'performance' FROM rep
  WHERE perf_status = 'OK' AND pr_auc_relative_drop IS NOT NULL
  UNION ALL
  SELECT batch_id, 8, 'recall_degradation',
         CASE WHEN recall_absolute_drop >= {p.recall_abs_alert} THEN 'ALERT'
              WHEN recall_absolute_drop >= {p.recall_abs_warn} THEN 'WARN' ELSE 'OK' END,
         recall_absolute_drop, {p.recall_abs_warn}, 'performance' FROM rep
  WHERE perf_status = 'OK' AND recall_absolute_drop IS NOT NULL
  UNION ALL
  SELECT batch_id, 9, 'precision_collapse', 'ALERT', precision_absolute_drop, {p.precision_abs_alert},
         'performance' FROM rep
  WHERE perf_status = 'OK' AND precision_absolute_drop >= {p.precision_abs_alert}),
sig_o AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY o) - 1 AS signal_order FROM sig),
flags AS (SELECT r.batch_id,
           coalesce(bool_or(s.category = 'data_quality' AND s.level = 'ALERT'), false) AS halt,
           coalesce(bool_or(s.category = 'performance' AND s.level = 'ALERT'), false) AS perf_alert,
           coalesce(bool_or(s.category IN ('drift', 'prediction') AND s.level = 'ALERT'), false) AS drift_alert,
           coalesce(bool_or(s.name = 'pr_auc_degradation' AND s.level = 'ALERT'), false) AS pr_alert,
           coalesce(bool_or(s.level = 'WARN'), false) AS any_warn,
           coalesce(max(CASE s.level WHEN 'ALERT' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END), 0) AS sev,
           count(*) FILTER (WHERE s.level IN ('WARN', 'ALERT')) AS n_msgs
          FROM rep r LEFT JOIN sig s USING (batch_id) GROUP BY r.batch_id),
fl AS (SELECT *, row_number() OVER (ORDER BY batch_id) AS seq,
              (perf_alert OR drift_alert) AND NOT halt AS trig,
              {'true' if p.prefer_recalibration else 'false'} AND drift_alert AND NOT perf_alert AND NOT pr_alert AS recal,
              epoch(strptime(batch_id || '-01', '%Y-%m-%d')) AS now_s FROM flags)"""


def _ladder(p: Policy) -> str:
    def step(src: str, prev_streak: str, prev_last: str) -> str:
        return f"""
    SELECT seq, batch_id, streak, action, cooldown,
           CASE WHEN action = 'RETRAIN' THEN now_s ELSE plast END AS last_s FROM (
      SELECT *, CASE WHEN halt THEN 'HALT'
                     WHEN NOT trig THEN (CASE WHEN any_warn THEN 'WATCH' ELSE 'NO_ACTION' END)
                     WHEN streak < {p.consecutive_windows_to_confirm} THEN 'WATCH'
                     WHEN cooldown THEN 'WATCH'
                     WHEN recal THEN 'RECALIBRATE_THRESHOLD' ELSE 'RETRAIN' END AS action FROM (
        SELECT f.*, CASE WHEN f.trig THEN {prev_streak} + 1 ELSE 0 END AS streak,
               coalesce(NOT f.halt AND {prev_last} IS NOT NULL
                        AND f.now_s - {prev_last} < {p.cooldown_days} * 86400, false) AS cooldown,
               {prev_last} AS plast
        FROM {src}) y) x"""
    return f"""
lad AS (
  {step('fl f WHERE f.seq = 1', '0', 'CAST(NULL AS DOUBLE)')}
  UNION ALL
  {step('lad l JOIN fl f ON f.seq = l.seq + 1', 'l.streak', 'l.last_s')}),
dec AS (SELECT l.batch_id, l.seq, l.action, l.streak AS confirmed_streak, l.cooldown AS cooldown_active,
               CASE WHEN f.halt THEN 'ALERT' WHEN f.sev = 2 THEN 'ALERT' WHEN f.sev = 1 THEN 'WARN'
                    ELSE 'OK' END AS severity, f.halt, f.trig, f.perf_alert, f.drift_alert, f.any_warn,
               f.n_msgs, f.recal
        FROM lad l JOIN fl f USING (seq))"""


def _with(body: str, final: str) -> str:
    kw = "WITH RECURSIVE" if "lad AS (" in body else "WITH"
    return f"{kw} {body.strip().lstrip(',')}\n{final}"


def _fixture_full(p: Policy = FP) -> str:
    return _report(p) + "," + _signals(p) + "," + _ladder(p)


R = "round({0}, 6) AS {1}"


def _r(col: str, name: str | None = None) -> str:
    return R.format(col, name or col.split(".")[-1])


def sql_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_batch"] = """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
        round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax, l_returnflag, l_linestatus,
        strftime(l_shipdate, '%Y-%m-%d') AS ship_date FROM lineitem"""
    full = _fixture_full()
    q["report_nonfinite_to_null"] = _with(full, "SELECT batch_id, " + ", ".join(
        f"round(CASE WHEN isfinite({c}) THEN {c} END, 6) AS {c}" for c in
        ("max_psi", "score_psi", "flag_rate", "flag_rate_relative_change", "pr_auc", "roc_auc")) + """,
        round(precision, 6) AS precision, round(recall, 6) AS recall,
        round(pr_auc_relative_drop, 6) AS pr_auc_relative_drop FROM rep""")
    q["state_history_tail"] = _with(full, """SELECT batch_id, action, severity, CAST(confirmed_streak AS BIGINT) AS streak,
        CAST(row_number() OVER (ORDER BY seq DESC) AS BIGINT) AS pos FROM dec WHERE NOT halt
        QUALIFY row_number() OVER (ORDER BY seq DESC) <= 50""")
    q["sample_rows"] = _with(TXN, """SELECT row_id, round(score, 6) AS score, CAST(label AS BIGINT) AS label
        FROM txn ORDER BY md5(row_id || '42'), row_id LIMIT 1000""")
    q["project_features"] = _with(TXN, "SELECT row_id, batch_id, " + ", ".join(_r(f) for f in TXN_FEATURES)
                                  + " FROM win")
    q["unpivot_features"] = _with(TXN, f"SELECT row_id, batch_id, feature, round(value, 6) AS value FROM ("
                                  + _long("txn", "row_id, batch_id, ") + ")")
    ev = """ev AS (SELECT CAST(event_id AS VARCHAR) AS row_id, strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d') AS batch_id,
        CAST(value AS DOUBLE) AS value, round(value / (value + 50), 4) AS score,
        CAST(event_type = 'error' AS INTEGER) AS label, CAST(ts AS TIMESTAMP) AS event_time FROM events)"""
    q["finite_filter"] = _with(ev + """, ev2 AS (SELECT * REPLACE (CASE WHEN CAST(row_id AS BIGINT) % 7 = 0
        OR CAST(row_id AS BIGINT) % 11 = 0 OR CAST(row_id AS BIGINT) % 13 = 0 OR CAST(row_id AS BIGINT) % 17 = 0
        THEN NULL ELSE value END AS value) FROM ev)""", "SELECT row_id, batch_id, feature, round(value, 6) AS value FROM ("
                               + _long("ev2", "row_id, batch_id, ", ["value", "score"]) + ") WHERE isfinite(value)")
    docs = """docs AS (SELECT CAST(d.doc_id AS VARCHAR) AS row_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
        round(d.n_chars / (d.n_chars + 1500.0), 4) AS score, CAST(l.toxic AS INTEGER) AS label
        FROM documents d LEFT JOIN labels l USING (doc_id))"""
    q["labeled_filter"] = _with(docs, "SELECT row_id, round(score, 6) AS score, CAST(label AS BIGINT) AS label "
                                "FROM docs WHERE label IS NOT NULL AND n_chars % 5 <> 0")
    q["scale_amount"] = _with(TXN, """, fit AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM ref)
        SELECT row_id, round((l_extendedprice - m) / s, 6) AS amount_scaled FROM win, fit""")
    q["score_batch"] = _with(TXN, "SELECT row_id, round(score, 6) AS score FROM txn_base")
    q["flag_scores"] = _with(TXN, f"SELECT row_id, round(score, 6) AS score, score >= {T} AND NOT isnan(score) "
                             "AS flagged FROM txn")
    q["quantile_edges"] = _with(DRIFT, """SELECT feature, CAST(i - 1 AS BIGINT) AS edge_index,
        round(inner_edges[i], 6) AS edge FROM edges, range(1, len(inner_edges) + 1) r(i)""")
    q["bin_proportions"] = _with(DRIFT, "SELECT batch_id, feature, CAST(bin AS BIGINT) AS bin, round(a, 6) AS share "
                                 "FROM shares")
    q["psi_features"] = _with(DRIFT, "SELECT batch_id, feature, round(psi, 6) AS psi FROM fd")
    q["psi_levels"] = _with(DRIFT, "SELECT batch_id, feature, round(psi, 6) AS psi, psi_level FROM fd")
    od = """o_long AS (SELECT 'x' AS feature, CAST(o_totalprice AS DOUBLE) AS value,
               o_orderdate < TIMESTAMP '1998-01-01' AS is_ref FROM orders),
        ref_long AS (SELECT feature, value FROM o_long WHERE is_ref),""" + _edges() + """,
        rb AS (SELECT len(list_filter(e.inner_edges, lambda x: x <= r.value)) AS bin, count(*) AS c
               FROM ref_long r JOIN edges e USING (feature) WHERE isfinite(value) GROUP BY ALL),
        cb AS (SELECT len(list_filter(e.inner_edges, lambda x: x <= o.value)) AS bin, count(*) AS c
               FROM o_long o JOIN edges e USING (feature) WHERE NOT is_ref AND isfinite(value) GROUP BY ALL),
        g AS (SELECT unnest(range(len(inner_edges) + 1)) AS bin, n FROM edges),
        nc AS (SELECT count(*) AS m FROM o_long WHERE NOT is_ref AND isfinite(value)),
        sh AS (SELECT greatest(coalesce(cb.c, 0) / nc.m, 1e-6) AS a, greatest(coalesce(rb.c, 0) / g.n, 1e-6) AS e
               FROM g LEFT JOIN rb USING (bin) LEFT JOIN cb USING (bin), nc)"""
    q["psi_two_tables"] = _with(od, "SELECT round(sum((a - e) * ln(a / e)), 6) AS psi FROM sh")
    q["ks_statistic"] = _with(DRIFT, "SELECT batch_id, feature, round(d, 6) AS ks_statistic FROM ks")
    q["ks_pvalue"] = _with(DRIFT, "SELECT batch_id, feature, round(ks_statistic, 6) AS ks_statistic, "
                           "round(ks_pvalue, 6) AS ks_pvalue, ks_significant FROM fd")
    q["mean_shift"] = _with(DRIFT, "SELECT batch_id, feature, round(reference_mean, 6) AS reference_mean, "
                            "round(current_mean, 6) AS current_mean, "
                            "round(mean_shift_in_ref_sds, 6) AS mean_shift_in_ref_sds FROM fd")
    q["missing_feature_rows"] = _with(DRIFT, """SELECT batch_id, feature, round(psi, 6) AS psi, psi_level, ks_significant,
        round(reference_mean, 6) AS reference_mean, false AS missing_from_batch FROM fd WHERE feature <> 'l_tax'
        UNION ALL SELECT DISTINCT batch_id, 'l_tax', NULL::DOUBLE, 'UNKNOWN', false,
        (SELECT round(reference_mean, 6) FROM rmom WHERE feature = 'l_tax'), true FROM win""")
    q["drift_summary"] = _with(DRIFT + "," + SUMMARY, """SELECT batch_id, n_features_tested, n_features_alert,
        n_features_warn, round(drifted_fraction, 6) AS drifted_fraction, round(max_psi, 6) AS max_psi FROM dsum""")
    q["top_drifted"] = _with(DRIFT + "," + SUMMARY, "SELECT batch_id, CAST(rk - 1 AS BIGINT) AS rank, feature "
                             "FROM ranked WHERE rk <= 5")
    edges = [float("-inf"), *SCORE_BAND_INNER_EDGES, float("inf")]
    lo = _list(edges[:-1])
    hi = _list(edges[1:])
    q["score_bands"] = _with(TXN + "," + REF_MODEL, f"""SELECT CAST(band AS BIGINT) AS band,
        round(CASE WHEN isfinite({lo}[band + 1]) THEN {lo}[band + 1] END, 6) AS lo,
        round(CASE WHEN isfinite({hi}[band + 1]) THEN {hi}[band + 1] END, 6) AS hi,
        round(expected, 6) AS expected FROM rbands""")
    q["prediction_drift"] = _with(_report(FP), """SELECT batch_id, n_rows, round(score_psi, 6) AS score_psi,
        round(mean_score, 6) AS mean_score, round(flag_rate, 6) AS flag_rate,
        round(reference_flag_rate, 6) AS reference_flag_rate,
        round(flag_rate_relative_change, 6) AS flag_rate_relative_change FROM pred""")
    q["profile_stats"] = _with(DRIFT, """SELECT e.feature, round(m.reference_mean, 6) AS mean, round(m.ref_std, 6) AS std,
        round(e.q[12], 6) AS p01, round(e.q[13], 6) AS p50, round(e.q[14], 6) AS p99, e.n,
        CAST(len(e.inner_edges) + 1 AS BIGINT) AS n_bins FROM edges e JOIN rmom m USING (feature)""")
    q["profile_round_trip"] = _with(DRIFT, """SELECT e.feature, round(m.reference_mean, 6) AS mean, round(e.q[13], 6) AS p50,
        e.n, CAST(len(e.inner_edges) + 1 AS BIGINT) AS n_bins, v.n_values FROM edges e JOIN rmom m USING (feature)
        JOIN (SELECT feature, count(DISTINCT value) AS n_values FROM ref_long WHERE isfinite(value) GROUP BY feature) v
        USING (feature)""")
    q["profile_ks_sample"] = _with(TXN, "SELECT feature, row_id, round(value, 6) AS value FROM ("
                                   + _long("ref", "row_id, ") + """) WHERE isfinite(value)
        QUALIFY row_number() OVER (PARTITION BY feature ORDER BY md5(row_id || feature || '42'), row_id) <= 5000""")
    q["build_reference"] = _with(TXN + """, r AS (SELECT *, row_number() OVER (ORDER BY event_time,
            md5(row_id || '42'), row_id) AS pos, count(*) OVER () AS n_all FROM ref),
        early AS (SELECT * FROM r WHERE pos <= floor(n_all * 0.8)),
        late AS (SELECT 1 AS row_one, * FROM r WHERE pos > floor(n_all * 0.8)),""" + _perf("late", "row_one", name="bm")
        + ", el AS (" + _long("early", "") + "), fs AS (SELECT feature, count(*) AS n, avg(value) AS mean, "
        "quantile_cont(value, 0.5) AS p50 FROM el WHERE isfinite(value) GROUP BY feature), "
        f"ls AS (SELECT count(*) AS n_scores, avg(score) AS mean_score, avg(CASE WHEN score >= {T} THEN 1.0 ELSE 0.0 END) "
        "AS flag_rate FROM late)", """SELECT feature, n, round(mean, 6) AS mean, round(p50, 6) AS p50, n_scores,
        round(mean_score, 6) AS mean_score, round(flag_rate, 6) AS flag_rate, round(pr_auc, 6) AS base_pr_auc,
        round(recall, 6) AS base_recall, round(precision, 6) AS base_precision FROM fs, ls, bm_f1""")
    q["profile_model"] = _with(_report(FP), """SELECT CAST(m.n_scores AS BIGINT) AS n_reference_rows,
        round(m.reference_fraud_rate, 6) AS reference_fraud_rate, 0.8::DOUBLE AS operating_threshold,
        round(m.mean_score, 6) AS mean_score, round(m.flag_rate, 6) AS flag_rate, m.n_scores,
        round(b.pr_auc, 6) AS base_pr_auc, round(b.recall, 6) AS base_recall,
        round(b.precision, 6) AS base_precision, round(b.f1, 6) AS base_f1 FROM rmodel m, bm_f1 b""")
    q["time_split"] = _with(TXN, """, r AS (SELECT row_id, event_time,
        row_number() OVER (ORDER BY event_time) AS pos, count(*) OVER () AS n FROM ref)
        SELECT CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'eval' END AS split,
               strftime(event_time, '%Y-%m-%d') AS day, count(*) AS n_rows FROM r GROUP BY ALL""")
    pm = _with(TXN + "," + _perf("win", "batch_id"), "")
    q["confusion_matrix"] = pm + """SELECT batch_id, CAST(tn AS BIGINT) AS true_negatives,
        CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives,
        CAST(tp AS BIGINT) AS true_positives FROM pm_f1"""
    q["threshold_metrics"] = pm + """SELECT batch_id, CAST(n_rows AS BIGINT) AS n_rows,
        CAST(n_frauds AS BIGINT) AS n_frauds, round(fraud_rate, 6) AS fraud_rate,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        CAST(alert_volume AS BIGINT) AS alert_volume, round(false_discovery_rate, 6) AS false_discovery_rate,
        CAST(missed_fraud_count AS BIGINT) AS missed_fraud_count FROM pm_f1"""
    q["pr_auc"] = pm + "SELECT batch_id, round(pr_auc, 6) AS pr_auc FROM pm_f1"
    q["roc_auc"] = pm + "SELECT batch_id, round(roc_auc, 6) AS roc_auc FROM pm_f1"
    q["baseline_comparison"] = _with(_report(FP), """SELECT batch_id, perf_status,
        round(pr_auc_relative_drop, 6) AS pr_auc_relative_drop, round(recall_absolute_drop, 6) AS recall_absolute_drop,
        round(precision_absolute_drop, 6) AS precision_absolute_drop FROM rep""")
    dp = Policy(min_labeled_rows=50, min_labeled_frauds=10)
    q["performance_status"] = _with(docs + ", d2 AS (SELECT lang AS batch_id, score, label FROM docs)"
                                    + "," + _perf("d2", "batch_id", "0.5"), f"""
        SELECT b.batch_id, CASE WHEN coalesce(p.n_rows, 0) < {dp.min_labeled_rows} THEN 'INSUFFICIENT'
            WHEN coalesce(p.n_frauds, 0) < {dp.min_labeled_frauds} THEN 'INSUFFICIENT' ELSE 'OK' END AS perf_status,
            CAST(coalesce(p.n_rows, 0) AS BIGINT) AS n_labeled,
            CASE WHEN p.n_rows >= {dp.min_labeled_rows} THEN CAST(p.n_frauds AS BIGINT) END AS n_frauds,
            CASE WHEN p.n_rows >= {dp.min_labeled_rows} THEN round(p.pr_auc, 6) END AS pr_auc
        FROM (SELECT DISTINCT batch_id FROM d2) b LEFT JOIN pm_f1 p USING (batch_id)""")
    q["label_maturity"] = _with(ev, """SELECT batch_id,
        floor((epoch(TIMESTAMP '2024-02-15 00:00:00') - epoch(max(event_time))) / 86400) >= 30 AS mature
        FROM ev GROUP BY batch_id""")
    sig_cols = "batch_id, name, level, round(value, 6) AS value, round(threshold, 6) AS threshold, category"
    for name, cats in (("signals_quality", "('data_quality')"), ("signals_drift", "('drift')"),
                       ("signals_prediction", "('prediction')"), ("signals_performance", "('performance')")):
        q[name] = _with(full, f"SELECT {sig_cols} FROM sig_o WHERE category IN {cats}")
    q["signals_all"] = _with(full, f"SELECT batch_id, CAST(signal_order AS BIGINT) AS signal_order, {sig_cols[10:]} "
                             "FROM sig_o")
    q["signals_missing_feature"] = _with(TXN, """SELECT DISTINCT batch_id, true AS halt, 'missing_features' AS name,
        'ALERT' AS level, 1.0::DOUBLE AS value, 0.0::DOUBLE AS threshold, 'data_quality' AS category FROM win""")
    q["severity"] = _with(full, "SELECT batch_id, severity FROM dec")
    q["window_flags"] = _with(full, "SELECT batch_id, halt, trig AS triggering, perf_alert, drift_alert, any_warn "
                              "FROM dec")
    q["alert_streak"] = _with(full, "SELECT batch_id, CAST(confirmed_streak AS BIGINT) AS streak FROM dec")
    q["decision_timeline"] = _with(full, """SELECT batch_id, action, CAST(confirmed_streak AS BIGINT) AS confirmed_streak,
        cooldown_active, severity FROM dec""")
    q["ladder_stream"] = _with(full, """SELECT batch_id, action, CAST(confirmed_streak AS BIGINT) AS confirmed_streak,
        cooldown_active FROM dec""")
    q["decision_runs"] = _with(full, """SELECT 'run ' || left(batch_id, 4) AS run_id, batch_id, action,
        CAST(confirmed_streak AS BIGINT) AS confirmed_streak, severity FROM dec WHERE left(batch_id, 4) IN ('2000', '2001')""")
    said = lambda text, *cols: "printf('" + text + "'" + "".join(f", {c}" for c in cols) + ")"
    q["decision_reasons"] = _with(full, f"""SELECT batch_id,
        CAST(CASE WHEN halt THEN 1 ELSE n_msgs + CASE WHEN NOT trig THEN 0 WHEN cooldown_active AND confirmed_streak >= {FP.consecutive_windows_to_confirm} THEN 2 ELSE 1 END END AS BIGINT) AS n_reasons,
        CASE WHEN halt OR NOT trig THEN NULL
             WHEN confirmed_streak < {FP.consecutive_windows_to_confirm}
                  THEN {said(HOLD_MSG, 'CAST(confirmed_streak AS BIGINT)', FP.consecutive_windows_to_confirm)}
             WHEN cooldown_active THEN {said(COOLDOWN_MSG, FP.cooldown_days)}
             WHEN recal THEN '{RECAL_MSG}'
             ELSE {said(RETRAIN_MSG, 'CAST(confirmed_streak AS BIGINT)')} END AS lead_reason
        FROM dec""")
    monitor_sql = """SELECT r.batch_id, r.n_rows, r.n_features_alert, r.n_ks_significant,
        round(r.max_psi, 6) AS max_psi, round(r.score_psi, 6) AS score_psi, round(r.flag_rate, 6) AS flag_rate, r.perf_status,
        round(r.pr_auc, 6) AS pr_auc, round(r.recall, 6) AS recall, round(r.precision, 6) AS precision,
        d.action, CAST(d.confirmed_streak AS BIGINT) AS confirmed_streak, d.severity
        FROM rep r JOIN dec d USING (batch_id)"""
    q["monitor_batch"] = _with(full, monitor_sql)
    window = "win AS (SELECT * FROM txn WHERE"
    rescored = full.replace(window, """win AS (SELECT * REPLACE ((l_quantity / 50) * 0.5 + (l_discount / 0.10) * 0.3
        + (l_tax / 0.08) * 0.2 AS score) FROM txn WHERE""")
    assert rescored.count("REPLACE (") == full.count(window) == 1
    q["monitor_scored"] = _with(rescored, monitor_sql)
    q["monitor_report"] = _with(full, """SELECT r.batch_id, r.n_rows, f.features, round(r.max_psi, 6) AS max_psi,
        round(r.score_psi, 6) AS score_psi, r.perf_status, round(r.recall, 6) AS recall, d.action
        FROM rep r JOIN dec d USING (batch_id) JOIN (SELECT batch_id, string_agg(feature || ':' || psi_level || ':' ||
            CAST(ks_significant AS VARCHAR), ',' ORDER BY coalesce(CASE WHEN isfinite(psi) THEN psi END, 0.0) DESC,
            feature_index) AS features FROM fd GROUP BY batch_id) f USING (batch_id)""")
    parts = []
    for pol in (FP, for_env("dev"), for_env("staging"), for_env("prod")):
        parts.append("(" + _with(_fixture_full(pol), f"""SELECT '{pol.env}' AS env, batch_id, action,
            CAST(confirmed_streak AS BIGINT) AS confirmed_streak, severity FROM dec""") + ")")
    q["policy_backtest"] = " UNION ALL ".join(parts)
    rows = []
    for env in ("dev", "staging", "prod"):
        pol = for_env(env)
        vals = []
        for k, typ in policy_fields():
            v = getattr(pol, k)
            if v is None:
                vals.append(f"CAST(NULL AS {'DOUBLE' if typ == 'double' else typ.upper()}) AS {k}")
            elif typ == "string":
                vals.append(f"'{v}' AS {k}")
            elif typ == "boolean":
                vals.append(f"{str(v).lower()} AS {k}")
            elif typ == "bigint":
                vals.append(f"CAST({v} AS BIGINT) AS {k}")
            else:
                vals.append(f"CAST({v!r} AS DOUBLE) AS {k}")
        rows.append(f"SELECT '{env}' AS env, " + ", ".join(vals))
    q["policy_table"] = _with(TXN + ", pol AS (" + " UNION ALL ".join(rows) + """),
        sz AS (SELECT batch_id, count(*) AS n FROM win GROUP BY batch_id)""", """SELECT pol.*,
        count(*) AS n_windows, CAST(sum(CASE WHEN sz.n < pol.min_batch_rows THEN 1 ELSE 0 END) AS BIGINT)
            AS n_small_windows
        FROM pol, sz GROUP BY ALL""")
    ths = _list(sweep_thresholds())
    sweep = f"""{TXN}, th AS (SELECT i - 1 AS idx, {ths}[i] AS threshold FROM range(1, 96) r(i)),
        tot AS (SELECT sum(label) AS P FROM win WHERE label IS NOT NULL),
        sw AS (SELECT th.threshold, tot.P,
                 count(w.row_id) AS alert_volume, coalesce(sum(w.label), 0) AS tp
               FROM th CROSS JOIN tot LEFT JOIN win w ON w.score >= th.threshold AND NOT isnan(w.score)
                    AND w.label IS NOT NULL
               GROUP BY th.threshold, tot.P),
        sm AS (SELECT threshold, CASE WHEN alert_volume > 0 THEN tp / alert_volume ELSE 0.0 END AS precision,
                      CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS recall, alert_volume, P - tp AS missed_fraud_count
               FROM sw),
        sf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                         ELSE 0.0 END AS f1 FROM sm)"""
    q["threshold_sweep"] = _with(sweep, """SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(alert_volume AS BIGINT) AS alert_volume,
        CAST(missed_fraud_count AS BIGINT) AS missed_fraud_count FROM sf""")
    prop = """SELECT round(threshold, 6) AS threshold, 0.8::DOUBLE AS previous_threshold, '{rule}' AS selection_rule,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
        'champion-1' AS model_version FROM sf ORDER BY {order} LIMIT 1"""
    q["recalibrate_f1"] = _with(sweep, prop.format(rule=f1_rule(), order="f1 DESC, threshold ASC"))
    q["recalibrate_recall"] = _with(sweep, prop.format(
        rule=recall_rule(0.95),
        order="(recall >= 0.95) DESC, CASE WHEN recall >= 0.95 THEN precision ELSE recall END DESC, threshold ASC"))
    gate = f"""{TXN},
        gs AS (SELECT 'score2' AS challenger, 'champion' AS role, score, label FROM win
               UNION ALL SELECT 'score2', 'challenger', score2, label FROM win
               UNION ALL SELECT 'score3', 'champion', score, label FROM win
               UNION ALL SELECT 'score3', 'challenger', score3, label FROM win),
        gk AS (SELECT challenger || '|' || role AS cr, score, label FROM gs),{_perf('gk', 'cr')},
        gm AS (SELECT split_part(cr, '|', 1) AS challenger, split_part(cr, '|', 2) AS role, * FROM pm_f1),
        gj AS (SELECT c.challenger, c.pr_auc AS ch_pr, l.pr_auc AS cl_pr, c.recall AS ch_rc, l.recall AS cl_rc,
                      l.precision AS cl_pc
               FROM gm c JOIN gm l ON c.challenger = l.challenger AND c.role = 'champion' AND l.role = 'challenger'),
        gc AS (SELECT challenger, 0 AS check_order, 'pr_auc_improvement' AS name,
                      coalesce(cl_pr - ch_pr >= 0.005, false) AS passed, cl_pr - ch_pr AS value,
                      CAST(0.005 AS DOUBLE) AS threshold FROM gj
               UNION ALL SELECT challenger, 1, 'recall_not_regressed', ch_rc - cl_rc <= 0.02, ch_rc - cl_rc, 0.02 FROM gj
               UNION ALL SELECT challenger, 2, 'precision_floor', cl_pc >= 0.5, cl_pc, 0.5 FROM gj),
        po AS (SELECT label, epoch(event_time) AS t FROM txn), pt AS (SELECT max(t) - 30 * 86400 AS cutoff FROM po),
        pr AS (SELECT count(*) AS n, coalesce(sum(label), 0) AS k FROM po, pt WHERE t <= cutoff AND t > cutoff - 180 * 86400),
        ga AS (SELECT 1 AS phase, * FROM gc
               UNION ALL SELECT 0, challenger, 0, 'min_training_rows', n >= 100, CAST(n AS DOUBLE), 100.0
                         FROM pr, (SELECT DISTINCT challenger FROM gc)
               UNION ALL SELECT 0, challenger, 1, 'min_training_frauds', k >= 1, CAST(k AS DOUBLE), 1.0
                         FROM pr, (SELECT DISTINCT challenger FROM gc))"""
    q["gate_metrics"] = _with(gate, """SELECT challenger, role, CAST(n_rows AS BIGINT) AS n_rows, round(pr_auc, 6) AS pr_auc,
        round(recall, 6) AS recall, round(precision, 6) AS precision, CAST(alert_volume AS BIGINT) AS alert_volume
        FROM gm""")
    q["gate_checks"] = _with(gate, """SELECT challenger, CAST(phase AS BIGINT) AS phase,
        CAST(check_order AS BIGINT) AS check_order, name, passed, round(value, 6) AS value,
        round(threshold, 6) AS threshold FROM ga""")
    names = "string_agg(name, ', ' ORDER BY phase, check_order) FILTER (WHERE NOT passed)"
    q["gate_result"] = _with(gate, f"""SELECT challenger, bool_and(passed) AS promote, count(*) AS n_checks,
        coalesce({names}, '') AS failed_checks, CASE WHEN bool_and(passed) THEN '{PROMOTE}'
        ELSE replace('{REJECT}', '%s', {names}) END AS summary FROM ga GROUP BY challenger""")
    q["promotion_audit"] = _with(gate, f"""SELECT 'gate 1' AS run_id, challenger, 'champion-1' AS champion_version,
        'challenger-1' AS challenger_version, bool_and(passed) AS promote, count(*) AS n_checks, CAST(2 AS BIGINT) AS n_metrics,
        CASE WHEN bool_and(passed) THEN '{PROMOTE}' ELSE replace('{REJECT}', '%s', {names}) END AS summary
        FROM ga GROUP BY challenger""")
    q["training_window"] = """WITH o AS (SELECT o_orderkey, epoch(CAST(o_orderdate AS TIMESTAMP)) AS t FROM orders),
        c AS (SELECT max(t) - 30 * 86400 AS cutoff FROM o)
        SELECT o_orderkey, CASE WHEN t > cutoff THEN 'holdout' WHEN t > cutoff - 180 * 86400 THEN 'train'
                                ELSE 'drop' END AS split FROM o, c"""
    q["training_preflight"] = _with(TXN, """, o AS (SELECT label, epoch(event_time) AS t FROM txn),
        c AS (SELECT max(t) - 30 * 86400 AS cutoff FROM o),
        tr AS (SELECT count(*) AS n, coalesce(sum(label), 0) AS k FROM o, c WHERE t <= cutoff AND t > cutoff - 180 * 86400)
        SELECT CAST(0 AS BIGINT) AS check_order, 'min_training_rows' AS name, n >= 50000 AS passed,
               CAST(n AS DOUBLE) AS value, 50000.0 AS threshold FROM tr
        UNION ALL SELECT 1, 'min_training_frauds', k >= 100, CAST(k AS DOUBLE), 100.0 FROM tr""")
    q["rebalance_positives"] = _with(TXN, """, pc AS (SELECT count(*) AS P FROM txn WHERE label = 1),
        nc AS (SELECT count(*) AS N FROM txn WHERE label IS NULL OR label <> 1)
        SELECT f.factor, CAST(1 AS BIGINT) AS label, CAST(floor(pc.P * f.factor) AS BIGINT) AS n_rows
        FROM (VALUES (0.5::DOUBLE), (2.5::DOUBLE)) f(factor), pc
        UNION ALL SELECT f.factor, CAST(0 AS BIGINT), nc.N FROM (VALUES (0.5::DOUBLE), (2.5::DOUBLE)) f(factor), nc""")
    q["drift_report_rows"] = _with(DRIFT, """SELECT batch_id, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY
        coalesce(CASE WHEN isfinite(psi) THEN psi END, 0.0) DESC, feature_index) AS BIGINT) AS row_order, feature,
        round(psi, 6) AS psi, psi_level, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue,
        round(mean_shift_in_ref_sds, 6) AS mean_shift_in_ref_sds FROM fd""")
    q["report_headline"] = _with(full, """SELECT r.batch_id, 'champion-1' AS model_version, r.n_rows, d.action,
        d.severity, r.n_features_alert, r.n_features_tested, round(r.max_psi, 6) AS max_psi,
        round(r.score_psi, 6) AS score_psi, round(r.flag_rate, 6) AS flag_rate,
        round(r.reference_flag_rate, 6) AS reference_flag_rate, round(r.pr_auc, 6) AS pr_auc,
        round(r.base_pr_auc, 6) AS base_pr_auc, round(r.recall, 6) AS recall, round(r.base_recall, 6) AS base_recall,
        round(r.precision, 6) AS precision, round(r.base_precision, 6) AS base_precision
        FROM rep r JOIN dec d USING (batch_id)""")
    q["daily_windows"] = _with(ev, """SELECT batch_id AS day, count(*) AS n_events,
        CAST(sum(CASE WHEN score >= 0.2 AND NOT isnan(score) THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged,
        CAST(sum(label) AS BIGINT) AS n_errors, round(avg(value), 6) AS mean_value FROM ev GROUP BY batch_id""")
    events = ev + f""", ref_ev AS (SELECT * FROM ev WHERE event_time < TIMESTAMP '{EVENTS_REFERENCE_END}'),
        ref_long AS ({_long("ref_ev", "", ["value", "score"])})"""
    core = _drift_core("0", 1)
    closed = "CAST(batch_id AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(event_time) FROM ev) - INTERVAL 1 DAY"
    q["daily_bin_psi"] = _with(events + f""", win_long AS ({_long("ev", "batch_id, ", ["value", "score"])}),
        {core}, total AS (SELECT batch_id, feature, count(*) AS n_rows FROM win_long GROUP BY ALL)""", f"""
        SELECT batch_id AS day, feature, t.n_rows, CAST(g.nf AS BIGINT) AS n_finite, g.bin, coalesce(b.c, 0) AS n,
               round(p.psi, 6) AS psi, CASE WHEN p.psi >= 0.25 THEN 'ALERT' WHEN p.psi >= 0.1 THEN 'WARN' ELSE 'OK' END AS psi_level
        FROM grid g JOIN total t USING (batch_id, feature) JOIN psi p USING (batch_id, feature)
        LEFT JOIN wbin b USING (batch_id, feature, bin) WHERE {closed}""")
    q["ks_pvalue_small"] = _with(events + f""", win_long AS (SELECT batch_id, 'value' AS feature, value FROM ev
        WHERE event_time >= TIMESTAMP '{EVENTS_REFERENCE_END}'), {core}""", """
        SELECT batch_id, feature, round(ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, ks_significant FROM fd""")
    q["late_labels_join"] = _with(docs + ", d2 AS (SELECT lang, score, label FROM docs),"
                                  + _perf("d2", "lang", "0.5"), """
        SELECT t.lang, t.n_scored, CAST(p.n_rows AS BIGINT) AS n_labeled, CAST(p.n_frauds AS BIGINT) AS n_frauds,
               round(p.pr_auc, 6) AS pr_auc, round(p.roc_auc, 6) AS roc_auc
        FROM (SELECT lang, count(*) AS n_scored FROM docs GROUP BY lang) t LEFT JOIN pm_f1 p USING (lang)""")
    arriving = ev + """, lab AS (SELECT row_id, label, event_time + to_days(CAST(CAST(row_id AS BIGINT) % 5 AS INTEGER)) AS came
            FROM ev WHERE CAST(row_id AS BIGINT) % 7 <> 0),
        lab2 AS (SELECT * FROM lab UNION ALL
                 SELECT row_id, 1 - label, came + INTERVAL 1 HOUR FROM lab WHERE CAST(row_id AS BIGINT) % 3 = 0)"""
    graded = """SELECT e.batch_id AS day, count(*) AS n_scored, count(n.label) AS n_labeled,
        CAST(sum(n.label) AS BIGINT) AS n_errors FROM ev e LEFT JOIN newest n USING (row_id)"""
    q["late_labels_stream"] = _with(arriving + """, newest AS (SELECT l.row_id, arg_max(l.label, came) AS label
        FROM lab2 l JOIN ev e USING (row_id) WHERE came BETWEEN event_time AND event_time + INTERVAL 2 DAY GROUP BY l.row_id)""",
        graded + """ WHERE e.batch_id < (SELECT strftime(max(event_time) - INTERVAL 4 DAY, '%Y-%m-%d') FROM ev)
        GROUP BY e.batch_id""")
    q["late_labels_days"] = _with(arriving + """, newest AS (SELECT row_id, arg_max(label, came) AS label FROM lab2
        GROUP BY row_id)""", graded + f""" GROUP BY e.batch_id
        HAVING max(e.event_time) <= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL {Policy().label_delay_days} DAY""")
    q["wide_feature_drift"] = _with(WIDE, """SELECT batch_id, feature, round(psi, 6) AS psi, psi_level,
        round(ks_statistic, 6) AS ks_statistic, ks_significant, round(0.01 / 64, 6) AS ks_alpha_corrected FROM fd""")
    q["wide_top_drifted"] = _with(WIDE + "," + SUMMARY, "SELECT batch_id, CAST(rk - 1 AS BIGINT) AS rank, feature "
                                  "FROM ranked WHERE rk <= 5")
    return q

