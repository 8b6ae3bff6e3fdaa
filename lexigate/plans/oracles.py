"""SQL equivalents of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from lexigate.config import DataRules
from lexigate.operators.drift import KS_EXACT_ROWS, KS_SERIES_TERMS
from lexigate.plans import inputs
from lexigate.plans.registered import (
    DOCUMENTED_METRICS,
    EVENTS_CUT,
    LINEITEM_NUMBERS,
    RUN,
    SHIP_CUT,
)
from lexigate.sources.provenance import local_provenance
from lexigate.sources.synthetic import NEGATIVE_TEMPLATES, POSITIVE_TEMPLATES

WHITESPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
LINE_BREAKS = r"[\t\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def clean(text: str) -> str:
    sql = f"lower(coalesce({text}, 'nan'))"
    for pattern, new in ((f"http[^{WHITESPACE}]+", ""), (r"<[^>\n]*>", ""), ("[^a-z0-9]+", " ")):
        sql = f"regexp_replace({sql}, '{pattern}', '{new}', 'g')"
    return f"trim({sql})"


def words(clean_sql: str) -> str:
    return f"list_filter(string_split({clean_sql}, ' '), lambda w: length(w) >= 2)"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g')"


def strings(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def ctes(*parts: str) -> str:
    return "with " + ",\n".join(parts)


def columns(expressions) -> str:
    return ", ".join(expressions)


REVIEWS = f"reviews as (select {columns(inputs.REVIEW_COLUMNS)} from documents join labels using (doc_id))"
DERIVED = f"""derived as (
  select row_id, review_text, sentiment, {clean('review_text')} as review_text_clean,
    length(review_text)::int as review_length,
    len(regexp_extract_all(review_text, '[^{WHITESPACE}]+'))::int as word_count, source
  from reviews)"""
SCORED = f"scored as (select {columns(inputs.SCORED_COLUMNS)} from labels)"
MULTICLASS = f"multiclass as (select {columns(inputs.MULTICLASS_COLUMNS)} from events)"
LOG = f"log as (select {columns(inputs.LOG_COLUMNS)} from events)"


# ---- quality -------------------------------------------------------------------------------


def null_rows(table: str, names, threshold: float) -> str:
    return "\nunion all ".join(
        f"select 'null_check' as \"check\", '{name}' as \"column\", "
        f"round(count(*) filter ({name} is null)::double / count(*), 9) as value, "
        f"{threshold}::double as threshold, "
        f"count(*) filter ({name} is null)::double / count(*) <= {threshold} as passed from {table}"
        for name in names
    )


def duplicate_row(table: str, names, threshold: float) -> str:
    return f"""select 'duplicate_check' as "check", null::varchar as "column",
  round((sum(n) - count(*))::double / sum(n), 9) as value, {threshold}::double as threshold,
  (sum(n) - count(*))::double / sum(n) <= {threshold} as passed
from (select count(*) as n from {table} group by {columns(names)})"""


def balance_row(table: str, label: str, threshold: float) -> str:
    return f"""select 'class_balance' as "check", null::varchar as "column",
  round(min(n)::double / sum(n), 9) as value, {threshold}::double as threshold,
  min(n)::double / sum(n) >= {threshold} as passed
from (select count(*) as n from {table} where {label} is not null group by {label})"""


def validation_report() -> str:
    rules = DataRules()
    names = ["review_text", "sentiment", "review_text_clean", "review_length", "word_count", "source"]
    return ctes(
        REVIEWS,
        DERIVED,
        f"""report as ({null_rows('derived', names, rules.max_null_pct)}
union all {duplicate_row('derived', names, rules.max_duplicate_pct)}
union all {balance_row('derived', 'sentiment', rules.min_class_ratio)})""",
    ) + """
select * from report union all
select 'overall', null, null, null, bool_and(passed) from report"""


# ---- fingerprints --------------------------------------------------------------------------


def row_code(names) -> str:
    return " || ".join(
        f"coalesce(length({n}::varchar)::varchar || ':' || {n}::varchar || ';', '~;')" for n in names
    )


def fingerprint(table: str, names) -> str:
    return f"""select substr(sha256(coalesce(sum(h), 0)::varchar || '|' || count(*)::varchar), 1, 12)
  as data_hash, count(*) as n_rows
from (select ('0x' || substr(md5({row_code(names)}), 1, 15))::bigint::hugeint as h from {table})"""


# ---- splits --------------------------------------------------------------------------------


def split_ctes(table: str, label: str, row_id: str, test, validation, seed: int) -> str:
    """``test`` and ``validation`` are (numerator, denominator), the latter of the remainder."""

    def quota(name: str, source: str, count: str, size) -> str:
        p, q = size
        return f"""{name}_share as (
  select *, ((sum({count}) over ())::hugeint * {p} + {q - 1}) // {q} as draw,
    (sum({count}) over ())::hugeint as total from {source}),
{name} as (
  select * exclude (draw, total, whole, rest), whole + case when
    row_number() over (order by rest desc, label) <= draw - sum(whole) over () then 1 else 0 end
    as n_{name}
  from (select *, draw * {count} // total as whole, draw * {count} % total as rest
        from {name}_share))"""

    return f"""classes as (select {label} as label, count(*) as n from {table} group by 1),
{quota('test', 'classes', 'n', test)},
remaining as (select *, n - n_test as n_left from test),
{quota('validation', 'remaining', 'n_left', validation)},
ranked as (
  select *, row_number() over (partition by {label} order by
    md5('{seed}:' || {row_id}::varchar) || ':' || {row_id}::varchar) as place from {table}),
assigned as (
  select ranked.* exclude (place), case when place <= n_test then 'test'
    when place <= n_test + n_validation then 'validation' else 'train' end as split
  from ranked join validation on ranked.{label} = validation.label)"""


REVIEW_SPLIT = split_ctes("reviews", "sentiment", "row_id", (1, 5), (1, 4), 42)
DERIVED_SPLIT = split_ctes("derived", "sentiment", "row_id", (1, 5), (1, 4), 42)


def folds_ctes(table: str, label: str, row_id: str, folds: int, seed: int = 42) -> str:
    return f"""classes as (
  select {label} as label, count(*) as n,
    coalesce(sum(count(*)) over (order by {label} rows between unbounded preceding and 1 preceding), 0)
      as first from {table} group by 1),
targets as (
  select label, cut, sum(floor((first + n - 1 - cut)::double / {folds})
      - floor((first - 1 - cut)::double / {folds})) over (partition by label order by cut) as target
  from classes, range({folds}) as r(cut)),
ranked as (
  select *, row_number() over (partition by {label} order by
    md5('{seed}:' || {row_id}::varchar) || ':' || {row_id}::varchar) as place from {table}),
folded as (
  select ranked.* exclude (place),
    (select count(*) from targets where targets.label = ranked.{label} and target < place)::int
      as fold
  from ranked)"""


# ---- features ------------------------------------------------------------------------------


def terms_ctes(table: str, row_id: str, clean_sql: str, prefix: str = "") -> str:
    return f"""{prefix}words as (select {row_id} as row_id, {words(clean_sql)} as w from {table}),
{prefix}terms as (
  select row_id, unnest(w) as term from {prefix}words
  union all
  select row_id, w[i] || ' ' || w[i + 1] from
    (select row_id, w, unnest(range(1, len(w))) as i from {prefix}words)),
{prefix}counts as (select row_id, term, count(*) as tf from {prefix}terms group by all)"""


def vocabulary_ctes(rows: str, prefix: str = "") -> str:
    return f"""{prefix}vocabulary as (
  select term, (row_number() over (order by term) - 1)::int as idx, df, tf,
    ln((1.0::double + (select count(*) from {rows})) / (1.0::double + df)) + 1.0::double as idf
  from (select term, count(*) as df, sum(tf)::bigint as tf from {prefix}counts group by term
        having count(*) >= 2 order by sum(tf) desc, term limit 10000))"""


def weights(counts: str, vocab: str) -> str:
    return f"""select row_id, idx, term, w / sqrt(sum(w * w) over (partition by row_id)) as weight
  from (select row_id, idx, term, (1.0::double + ln(c.tf::double)) * idf as w
        from {counts} c join {vocab} using (term))"""


SCALING = """scaling as (
  select avg(review_length::double) as length_mean, avg(word_count::double) as words_mean,
    case when stddev_pop(review_length::double) = 0 then 1 else stddev_pop(review_length::double) end
      as length_scale,
    case when stddev_pop(word_count::double) = 0 then 1 else stddev_pop(word_count::double) end
      as words_scale
  from assigned where split = 'train')"""
TRAIN = "train as (select * from assigned where split = 'train')"


# ---- metrics -------------------------------------------------------------------------------


def class_scores(pairs: str, keys: str = "") -> str:
    """Needs ``pairs`` with (keys,) label, prediction, n."""
    lead = f"{keys}, " if keys else ""
    return f"""select *, case when precision + recall = 0 then 0
    else 2 * precision * recall / (precision + recall) end as f1
from (select *, case when predicted = 0 then 0 else hits::double / predicted end as precision,
        case when support = 0 then 0 else hits::double / support end as recall
      from (select {lead}label, sum(support) as support, sum(predicted) as predicted,
              sum(hits) as hits
            from (select {lead}label, n as support, 0 as predicted,
                    case when label = prediction then n else 0 end as hits from {pairs}
                  union all select {lead}prediction, 0, n, 0 from {pairs})
            group by {lead}label))"""


SUMMARY = """sum(hits)::double / sum(support) as accuracy,
  sum(f1 * support) / sum(support) as f1_weighted,
  sum(precision * support) / sum(support) as precision_weighted,
  sum(recall * support) / sum(support) as recall_weighted, sum(support)::bigint as n_rows"""


def pairs(table: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return f"pairs as (select {lead}label, prediction, count(*) as n from {table} group by all)"


def evaluation_ctes() -> str:
    return f"""{SCORED},
{pairs('scored')},
summary as (select {SUMMARY} from ({class_scores('pairs')})),
majority as (select label from scored group by label order by count(*) desc, label limit 1),
base_pairs as (
  select label, (select label from majority) as prediction, count(*) as n from scored group by label),
base as (select {SUMMARY} from ({class_scores('base_pairs')})),
evaluation as (
  select summary.*, (select label from majority) as baseline_prediction,
    base.accuracy as baseline_accuracy, base.f1_weighted as baseline_f1_weighted,
    summary.accuracy - base.accuracy as accuracy_over_baseline
  from summary, base)"""


def score_ctes(table: str, label: str, score: str, positive: str) -> str:
    return f"""by_score as (
  select {score} as score, count(*) filter ({label} = '{positive}') as pos,
    count(*) filter ({label} <> '{positive}') as neg from {table} group by 1),
points as (
  select score, pos, neg, sum(pos) over w as tps, sum(neg) over w as fps,
    sum(pos) over () as p, sum(neg) over () as n,
    lead(pos) over w as next_pos, lead(neg) over w as next_neg,
    row_number() over w as place
  from by_score window w as (order by score desc)),
areas as (
  select sum(neg * (tps - pos + pos / 2.0::double)) / (max(p)::double * max(n)::double) as roc_auc,
    sum(pos::double / p * (tps::double / (tps + fps) +
      case when tps - pos + fps - neg = 0 then 1
      else (tps - pos)::double / (tps - pos + fps - neg) end) / 2) as pr_auc
  from points)"""


SCORED_POINTS = score_ctes("scored", "label", "score", "positive")


# ---- latency, gate -------------------------------------------------------------------------

LATENCY = """latency as (
  select round(avg(latency_ms), 3) as mean_latency_ms,
    round(quantile_cont(latency_ms, 0.95), 3) as p95_latency_ms,
    round(quantile_cont(latency_ms, 0.99), 3) as p99_latency_ms, count(*) as n_runs from log)"""


def promotion_gate() -> str:
    rules = RUN.gate
    return ctes(
        evaluation_ctes(),
        LOG,
        LATENCY,
        f"""checks as (
  select 'accuracy' as "check", accuracy as value, {rules.min_accuracy}::double as threshold,
    accuracy >= {rules.min_accuracy} as passed from evaluation
  union all select 'f1_weighted', f1_weighted, {rules.min_f1}, f1_weighted >= {rules.min_f1}
    from evaluation
  union all select 'accuracy_over_baseline', accuracy_over_baseline,
    {rules.min_accuracy_over_baseline}, accuracy_over_baseline >= {rules.min_accuracy_over_baseline}
    from evaluation
  union all select 'latency_p95', p95_latency_ms, {rules.max_latency_ms},
    p95_latency_ms <= {rules.max_latency_ms} from latency)""",
    ) + """
select "check", round(value, 6) as value, threshold, passed,
  (select bool_and(passed) from checks) as overall_passed from checks"""


def golden_check() -> str:
    rows = ", ".join(f"('{name}', {value}::double)" for name, value in DOCUMENTED_METRICS.items())
    return ctes(
        evaluation_ctes(),
        SCORED_POINTS,
        f"expected as (select * from (values {rows}) t(metric, expected))",
        """actual as (
  select 'accuracy' as metric, accuracy as value from evaluation
  union all select 'f1_weighted', f1_weighted from evaluation
  union all select 'baseline_accuracy', baseline_accuracy from evaluation
  union all select 'accuracy_over_baseline', accuracy_over_baseline from evaluation
  union all select 'roc_auc', roc_auc from areas union all select 'pr_auc', pr_auc from areas)""",
    ) + """
select metric, expected, round(value, 6) as actual,
  coalesce(abs(value - expected) <= 0.02, false) as passed
from expected left join actual using (metric)"""


# ---- drift ---------------------------------------------------------------------------------


def values_cte(table: str, names, ts: str, cut) -> str:
    rows = "\n  union all ".join(
        f"select '{n}' as \"column\", {n}::double as value, ({ts} >= timestamp '{cut}')::int as side "
        f"from {table} where {n} is not null"
        for n in names
    )
    return f"vals as ({rows})"


PSI = """bounds as (
  select "column", min(value) as lo, max(value) as hi, count(*) filter (side = 0) as n0,
    count(*) filter (side = 1) as n1 from vals group by 1),
binned as (
  select v."column", side, len(list_filter(range(1, 10),
    lambda i: v.value >= b.lo + i * ((b.hi - b.lo) / 10))) as bin
  from vals v join bounds b on v."column" = b."column"),
shares as (
  select b."column", (count(x.side) filter (x.side = 0) + 1)::double / (max(n0) + 10) as r,
    (count(x.side) filter (x.side = 1) + 1)::double / (max(n1) + 10) as c
  from (select *, unnest(range(10)) as bin from bounds) b
  left join binned x on x."column" = b."column" and x.bin = b.bin
  group by b."column", b.bin),
psi as (select "column", sum((c - r) * ln(c / r)) as psi from shares group by 1)"""
KS = f"""per_value as (
  select "column", value, count(*) filter (side = 0) as r, count(*) filter (side = 1) as c
  from vals group by 1, 2),
gaps as (
  select "column", max(gap) as ks_statistic, max(n0) as n0, max(n1) as n1
  from (select "column", abs(sum(r) over w / (sum(r) over (partition by "column"))::double
            - sum(c) over w / (sum(c) over (partition by "column"))::double) as gap,
          sum(r) over (partition by "column") as n0, sum(c) over (partition by "column") as n1
        from per_value window w as (partition by "column" order by value))
  group by 1),
sized as (
  select *, ks_statistic * sqrt(n0::double * n1 / (n0 + n1)) as x, n0 + n1 as n,
    round(ks_statistic * lcm(n0, n1))::bigint * gcd(n0, n1) as far,
    (round(ks_statistic * lcm(n0, n1))::bigint * gcd(n0, n1)) // (n0 + n1) + 2 as half
  from (select "column", ks_statistic, n0::bigint as n0, n1::bigint as n1 from gaps)),
-- lists are antidiagonals of lattice points, from s * n0 // n - half on
ks as (
  select "column", ks_statistic, case
    when greatest(n0, n1) <= {KS_EXACT_ROWS} and far = 0 then 1
    when greatest(n0, n1) <= {KS_EXACT_ROWS} then list_reduce(
      list_prepend(list_transform(range(2 * half + 2), lambda k: case when k = half then 0.0 else 1.0 end::double),
        list_transform(range(1, n + 1), lambda s: [s::double])),
      lambda v, s: list_transform(range(2 * half + 2), lambda k: case
        when abs((s[1]::bigint * n0 // n - half + k) * n - s[1]::bigint * n0) >= far then 1.0
        else greatest(0, least(1, (s[1]::bigint * n0 // n - half + k) / s[1])) * coalesce(v[
            k + s[1]::bigint * n0 // n - (s[1]::bigint - 1) * n0 // n], 1.0)
          + greatest(0, least(1, 1 - (s[1]::bigint * n0 // n - half + k) / s[1])) * coalesce(v[
            k + s[1]::bigint * n0 // n - (s[1]::bigint - 1) * n0 // n + 1], 1.0)
        end))[half + 1]
    when x < 0.2 then 1 else least(1, greatest(0,
    2 * list_sum(list_transform(range(1, {KS_SERIES_TERMS + 1}),
      lambda k: (case when k % 2 = 1 then 1 else -1 end) * exp(-2.0::double * k * k * x * x))))) end
    as ks_pvalue
  from sized)"""


# ---- audits, registry ----------------------------------------------------------------------


def first_violation(rules) -> str:
    return "case " + " ".join(
        f"when not coalesce({holds}, false) then '{name}'" for name, holds in rules
    ) + " end as violation"


def lineage_audit() -> str:
    def kind(path):
        return f"coalesce(json_type(j, '{path}'), '')"

    def filled(path):
        return f"{kind(path)} = 'VARCHAR' and json_extract_string(j, '{path}') <> ''"

    whole = "('BIGINT', 'UBIGINT', 'BOOLEAN')"
    number = "('BIGINT', 'UBIGINT', 'DOUBLE')"
    rules = [
        ("not_an_object", f"{kind('$')} = 'OBJECT'"),
        ("data_hash", filled("$.data_hash")),
        ("absolute_path", "lineage not like '%: \"/%'"),
        ("feature_schema", f"{kind('$.feature_schema')} = 'OBJECT'"),
        ("text_column", f"{kind('$.feature_schema.text_column')} = 'VARCHAR'"),
        ("label_column", f"{kind('$.feature_schema.label_column')} = 'VARCHAR'"),
        ("numeric_columns", f"{kind('$.feature_schema.numeric_columns')} = 'ARRAY'"),
        ("dataset", f"{kind('$.dataset')} = 'OBJECT'"),
        ("dataset_kind", filled("$.dataset.kind")),
        ("dataset_key", filled("$.dataset.key")),
        ("dataset_license", filled("$.dataset.license")),
        ("split", f"{kind('$.split')} = 'OBJECT'"),
        ("random_state", f"{kind('$.split.random_state')} in {whole}"),
        (
            "test_size",
            f"{kind('$.split.test_size')} in {number} and "
            "json_extract(j, '$.split.test_size')::double > 0 and "
            "json_extract(j, '$.split.test_size')::double < 1",
        ),
        (
            "stratified",
            f"{kind('$.split.stratified')} = 'BOOLEAN' and "
            "json_extract_string(j, '$.split.stratified') = 'true'",
        ),
    ]
    return ctes(
        f"records as (select {columns(inputs.LINEAGE_COLUMNS)} from documents)",
        "parsed as (select *, lineage::json as j from records)",
    ) + f" select lineage_id, {first_violation(rules)} from parsed"


def gate_report_audit() -> str:
    from lexigate.operators.gate import REQUIRED_CHECKS

    checks = "$.performance_gate.checks"

    def kind(path):
        return f"coalesce(json_type(j, '{path}'), '')"

    def number(path):
        return f"(json_extract_string(j, '{path}')::double)"

    numeric = "('BIGINT', 'UBIGINT', 'DOUBLE')"
    rules = [
        ("not_an_object", f"{kind('$')} = 'OBJECT'"),
        ("not_evaluated", "json_extract_string(j, '$.evaluation_status') in ('passed', 'failed')"),
        ("hash_mismatch", "json_extract_string(j, '$.data_hash') = lineage_hash"),
        ("metrics_or_latency", f"{kind('$.metrics')} = 'OBJECT' and {kind('$.latency')} = 'OBJECT'"),
        ("gate_checks", f"{kind(checks)} = 'OBJECT'"),
        (
            "gate_inventory",
            f"list_sort(json_keys(j, '{checks}')) = [{strings(sorted(REQUIRED_CHECKS))}]",
        ),
    ]
    verdicts = []
    for name, (section, metric, direction) in REQUIRED_CHECKS.items():
        paths = [f"$.{section}.{metric}", f"{checks}.{name}.value", f"{checks}.{name}.threshold"]
        sign = ">=" if direction == "minimum" else "<="
        verdict = f"({number(paths[1])} {sign} {number(paths[2])})"
        verdicts.append(verdict)
        rules += [
            (f"{name}_not_an_object", f"{kind(f'{checks}.{name}')} = 'OBJECT'"),
            (f"{name}_not_numeric", " and ".join(f"{kind(p)} in {numeric}" for p in paths)),
            (f"{name}_not_source", f"{number(paths[1])} = {number(paths[0])}"),
            (
                f"{name}_inconsistent",
                f"json_extract_string(j, '{checks}.{name}.passed') = {verdict}::varchar",
            ),
        ]
    everything = "(" + " and ".join(verdicts) + ")"
    rules += [
        (
            "overall_inconsistent",
            "json_extract_string(j, '$.performance_gate.overall_passed') = "
            f"{everything}::varchar",
        ),
        (
            "status_inconsistent",
            f"(json_extract_string(j, '$.evaluation_status') = 'passed') = {everything}",
        ),
    ]
    return ctes(
        f"records as (select {columns(inputs.REPORT_COLUMNS)} from documents)",
        "parsed as (select *, case when json_valid(report) then report::json end as j from records)",
    ) + f" select report_id, {first_violation(rules)} from parsed"


def dimension_audit() -> str:
    rules = [
        ("expected_dimension", "expected_dim > 0"),
        (
            "scaler_dimension",
            "case when n_numeric > 0 then scaler_dim is not distinct from n_numeric "
            "else scaler_dim is null end",
        ),
        ("transformer_dimension", "tfidf_dim + n_numeric = expected_dim"),
        ("metadata_dimension", "metadata_total = expected_dim"),
        ("model_dimension", "coalesce(model_dim, expected_dim) = expected_dim"),
    ]
    return (
        ctes(f"records as (select {columns(inputs.DIMENSION_COLUMNS)} from part)")
        + f" select bundle_id, {first_violation(rules)} from records"
    )


REGISTRY = f"""moves as (
  select *, row_number() over (partition by model, version order by ts, event_id) as step,
    model <> '' and not contains(model, '/') and not contains(model, '..') as safe,
    new_stage in ('none', 'staging', 'production', 'archived') as known
  from (select {columns(inputs.REGISTRY_COLUMNS)} from events)),
seen as (
  select *,
    max(case when safe and (new_stage = 'none' or (new_stage = 'staging' and gate_passed))
      then step end) over w as registered,
    max(case when safe and (new_stage in ('none', 'archived')
      or (new_stage = 'staging' and gate_passed)) then step end) over w as settled,
    max(case when safe and new_stage = 'production' and gate_passed then step end) over w
      as requested
  from moves
  window w as (partition by model, version order by step
               rows between unbounded preceding and 1 preceding)),
judged as (
  select a.*, case when not a.safe then 'unsafe_name' when not a.known then 'invalid_stage'
    when a.registered is null and a.new_stage in ('production', 'archived') then 'not_registered'
    when a.new_stage = 'production' and not coalesce(
      b.new_stage = 'staging' and (a.requested is null or a.requested < a.settled), false)
      then 'not_in_staging'
    when a.new_stage in ('staging', 'production') and not a.gate_passed then 'gate_not_passed' end
    as reason
  from seen a left join moves b
    on a.model = b.model and a.version = b.version and a.settled = b.step),
own as (
  select model, version, min((ts, event_id)) as first, arg_max(new_stage, step) as stage,
    max(case when new_stage = 'production' then (ts, event_id) end) as promoted
  from judged where reason is null group by 1, 2),
state as (
  select model, version, row_number() over (partition by model order by first) as version_number,
    case when stage = 'production' and promoted < max(promoted) over (partition by model)
      then 'archived' else stage end as stage
  from own),
entries as (
  select model, version, version_number, stage, model || '/v' || version_number::varchar
    as bundle_path from state)"""


def request_rows() -> str:
    return "\n  union all ".join(
        f"select '{name}' as channel, {columns(exprs)} from {name}"
        for name, exprs in inputs.REQUEST_COLUMNS.items()
    )


def oracle_sql() -> dict[str, str]:
    document_words = f"select doc_id, {words(clean('text'))} as w from documents"
    lines = f"""lines as (
  select doc_id, {strip("regexp_replace(text, '" + LINE_BREAKS + "', ' ', 'g')")} as body,
    quality, source from documents left join labels using (doc_id))"""
    digit = "('0x' || substr(md5('42:' || o_orderkey::varchar), 1, 8))::bigint % 5 + 1"
    log_after = f"{REVIEWS}, {DERIVED}, {DERIVED_SPLIT}, {TRAIN}"
    record = {k: v for k, v in local_provenance("documents.parquet", 0).items() if k != "n_rows"}
    terms_train = terms_ctes("train", "row_id", "review_text_clean")
    terms_all = terms_ctes("derived", "row_id", "review_text_clean")
    return {
        "clean_text": f"select doc_id, {clean('text')} as clean from documents",
        "clean_pages": f"select page_id, {clean('html')} as clean from pages",
        "derived_columns": ctes(REVIEWS, DERIVED) + " select * from derived",
        "tokens": ctes(REVIEWS, DERIVED)
        + f""", t as (select row_id, {words('review_text_clean')} as w from derived)
select row_id, len(w)::bigint as n_tokens, array_to_string(w, ' ') as tokens from t""",
        "raw_tokens": """with t as (select doc_id, regexp_extract_all(
  strip_accents(lower(text)), '[\\p{L}\\p{N}_]{2,}') as w from documents)
select doc_id, len(w)::bigint as n_tokens, md5(array_to_string(w, ' ')) as tokens_md5 from t""",
        "ngrams": f"""with t as ({document_words}), g as (select doc_id, list_concat(w,
  list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as w from t)
select doc_id, len(w)::bigint as n_terms, md5(array_to_string(w, '|')) as terms_md5 from g""",
        "null_check": ctes("j as (select * from documents left join labels using (doc_id))")
        + " " + null_rows("j", ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"], 0.05),
        "duplicate_check": duplicate_row("documents", ["text", "lang", "source", "n_chars"], 0.10),
        "class_balance": ctes(REVIEWS) + " " + balance_row("reviews", "sentiment", 0.10),
        "class_distribution": """select event_type as label, count(*) as n,
  round(count(*)::double / (select count(*) from events), 9) as share from events group by 1""",
        "validation_report": validation_report(),
        "data_fingerprint": ctes(REVIEWS, DERIVED)
        + " "
        + fingerprint(
            "derived",
            ["row_id", "review_text", "sentiment", "review_text_clean", "review_length",
             "word_count", "source"],
        ),
        "data_fingerprint_orders": fingerprint(
            "orders",
            ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
             "o_orderpriority"],
        ),
        "lineage_match": ctes(
            "a as (select doc_id, quality, text from documents join labels using (doc_id))",
            "b as (select doc_id, case when toxic = 1 then 0 else quality end as quality, text "
            "from documents join labels using (doc_id))",
            f"x as ({fingerprint('a', ['doc_id', 'quality', 'text'])})",
            f"y as ({fingerprint('b', ['doc_id', 'quality', 'text'])})",
        )
        + """ select x.data_hash as left_hash, y.data_hash as right_hash, x.n_rows as left_rows,
  y.n_rows as right_rows, x.data_hash = y.data_hash and x.n_rows = y.n_rows as matches from x, y""",
        "parse_labelled_lines": ctes(lines)
        + """ select doc_id, body as review_text,
  case quality when 1 then 'positive' else 'negative' end as sentiment, source
from lines where quality is not null and body <> ''""",
        "parse_quarantine_counts": ctes(lines)
        + """ select source, count(*) filter (quality is not null and body <> '') as parsed,
  count(*) filter (quality is null and body <> '' or quality is not null and body = '') as skipped
from lines group by source""",
        "csv_roundtrip": ctes(REVIEWS) + " select * from reviews",
        "synthetic_reviews": f"""select o_orderkey as row_id, case when o_orderkey % 2 = 0
  then [{strings(POSITIVE_TEMPLATES)}][{digit}] else [{strings(NEGATIVE_TEMPLATES)}][{digit}] end
  || ' number ' || o_orderkey::varchar as review_text,
  case when o_orderkey % 2 = 0 then 'positive' else 'negative' end as sentiment,
  'synthetic' as source from orders""",
        "provenance": "select * from (values "
        + ", ".join(f"({strings([k, v])})" for k, v in record.items())
        + ") t(field, value) union all select 'n_rows', count(*)::varchar from documents",
        "data_manifest": ctes(
            REVIEWS,
            f"f as ({fingerprint('reviews', ['row_id', 'review_text', 'sentiment', 'source'])})",
        )
        + " select data_hash, 'user-supplied' as source_path, n_rows, 4::bigint as n_cols from f",
        "checksum_audit": """with actual as (
  select 'doc-' || doc_id::varchar || '.txt' as file, sha256(text) as found from documents),
pinned as (
  select 'doc-' || doc_id::varchar || '.txt' as file,
    sha256(case when toxic = 1 then text || 'x' else text end) as pinned
  from documents join labels using (doc_id)
  union all select 'page-' || page_id::varchar || '.html', sha256(html) from pages)
select file, case when found is null then 'missing' when pinned is null then 'unexpected'
  when found <> pinned then 'mismatch' else 'ok' end as status
from actual full join pinned using (file)""",
        "stratified_split": ctes(REVIEWS, REVIEW_SPLIT)
        + " select row_id, sentiment, split from assigned",
        "stratified_split_orders": ctes(
            "slim as (select o_orderkey, o_orderpriority from orders)",
            split_ctes("slim", "o_orderpriority", "o_orderkey", (3, 20), (2, 17), 7),
        )
        + " select * from assigned",
        "split_sizes": ctes(REVIEWS, REVIEW_SPLIT)
        + " select split, sentiment as label, count(*) as n from assigned group by all",
        "split_overlap": ctes(REVIEWS, REVIEW_SPLIT)
        + """, parts as (select split, row_id from assigned),
pairs as (select * from (values ('test', 'train'), ('test', 'validation'), ('train', 'validation'))
  t(a, b))
select a || '&' || b as relation, (select count(*) from (
    select row_id from parts where split = a intersect select row_id from parts where split = b))
  as n from pairs
union all select 'whole-union', count(*) from (
  select row_id from reviews except all select row_id from parts)
union all select 'union-whole', count(*) from (
  select row_id from parts except all select row_id from reviews)""",
        "cv_folds": ctes(REVIEWS, folds_ctes("reviews", "sentiment", "row_id", 5))
        + " select row_id, sentiment, fold from folded",
        "cv_fold_rows": "with "
        + log_after
        + f""", train_part as (select row_id, sentiment from assigned where split = 'train'),
{folds_ctes('train_part', 'sentiment', 'row_id', 5).replace('classes', 'fold_classes').replace('ranked', 'fold_ranked')}
select fold, sentiment, count(*) as n_rows from folded group by all""",
        "vocabulary": ctes(
            terms_ctes("documents", "doc_id", clean("text")), vocabulary_ctes("documents")
        )
        + " select term, idx, df, tf, round(idf, 9) as idf from vocabulary",
        "tfidf_fit_transform": ctes(
            REVIEWS, DERIVED, terms_all, vocabulary_ctes("derived"),
            f"weighted as ({weights('counts', 'vocabulary')})",
        )
        + " select row_id, term, round(weight, 6) as weight from weighted",
        "tfidf_transform": "with "
        + log_after
        + f""", held_out as (select * from assigned where split <> 'train'),
{terms_train}, {vocabulary_ctes('train')},
{terms_ctes('held_out', 'row_id', 'review_text_clean', 'held_')},
weighted as ({weights('held_counts', 'vocabulary')})
select row_id, term, round(weight, 6) as weight from weighted""",
        "scaled_numeric": "with "
        + log_after
        + f""", {SCALING}
select row_id, round((review_length - length_mean) / length_scale, 6) as review_length,
  round((word_count - words_mean) / words_scale, 6) as word_count from derived, scaling""",
        "leakage_terms": "with "
        + log_after
        + f""", held_out as (select * from assigned where split <> 'train'),
{terms_train}, {vocabulary_ctes('train')},
{terms_ctes('held_out', 'row_id', 'review_text_clean', 'held_')},
outside as (select distinct term from held_counts where term not in (select term from counts))
select (select count(*) from vocabulary) as vocabulary_terms,
  (select count(*) from outside) as outside_only_terms,
  (select count(*) from vocabulary where term in (select term from outside)) as leaked_terms""",
        "features": "with "
        + log_after
        + f""", held_out as (select * from assigned where split = 'validation'),
{terms_train}, {vocabulary_ctes('train')}, {SCALING},
{terms_ctes('held_out', 'row_id', 'review_text_clean', 'held_')},
weighted as ({weights('held_counts', 'vocabulary')})
select row_id, idx, round(weight, 6) as value from weighted
union all select row_id, (select count(*) from vocabulary)::int,
  round((review_length - length_mean) / length_scale, 6) from held_out, scaling
union all select row_id, (select count(*) from vocabulary)::int + 1,
  round((word_count - words_mean) / words_scale, 6) from held_out, scaling""",
        "weighted_scoring": "with "
        + log_after
        + f""", held_out as (select * from assigned where split = 'validation'),
{terms_train}, {vocabulary_ctes('train')}, {SCALING},
{terms_ctes('held_out', 'row_id', 'review_text_clean', 'held_')},
weighted as ({weights('held_counts', 'vocabulary')}),
entries as (select row_id, idx, weight as value from weighted
  union all select row_id, (select count(*) from vocabulary)::int,
    (review_length - length_mean) / length_scale from held_out, scaling
  union all select row_id, (select count(*) from vocabulary)::int + 1,
    (word_count - words_mean) / words_scale from held_out, scaling),
margins as (select row_id, sum(value * (
    ('0x' || substr(md5(idx::varchar), 1, 6))::bigint::double / 16777216 - 0.5)) as margin
  from entries group by row_id),
scored as (select row_id, margin, 1 / (1 + exp(-margin)) as p from margins)
select row_id, case when margin > 0 then 'positive' else 'negative' end as prediction,
  round(greatest(p, 1 - p), 4) as confidence, round(p, 6) as score from scored""",
        "confusion_matrix": ctes(MULTICLASS)
        + """, classes as (select label as c from multiclass union select prediction from multiclass)
select a.c as label, b.c as prediction, count(m.label) as n
from classes a cross join classes b left join multiclass m on m.label = a.c and m.prediction = b.c
group by all""",
        "classification_metrics": ctes(SCORED, pairs("scored"))
        + f""", s as (select {SUMMARY} from ({class_scores('pairs')}))
select round(accuracy, 6) as accuracy, round(f1_weighted, 6) as f1_weighted,
  round(precision_weighted, 6) as precision_weighted, round(recall_weighted, 6) as recall_weighted,
  n_rows from s""",
        "classification_report": ctes(MULTICLASS, pairs("multiclass"))
        + f""", s as ({class_scores('pairs')})
select 'class' as kind, label, round(precision, 6) as precision, round(recall, 6) as recall,
  round(f1, 6) as f1, support::bigint as support from s
union all select 'accuracy', null, round(sum(hits)::double / sum(support), 6),
  round(sum(hits)::double / sum(support), 6), round(sum(hits)::double / sum(support), 6),
  sum(support)::bigint from s
union all select 'macro avg', null, round(avg(precision), 6), round(avg(recall), 6),
  round(avg(f1), 6), sum(support)::bigint from s
union all select 'weighted avg', null, round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  sum(support)::bigint from s""",
        "majority_baseline": ctes(REVIEWS, REVIEW_SPLIT)
        + f""", majority as (select sentiment from assigned where split = 'train'
  group by 1 order by count(*) desc, sentiment limit 1),
pairs as (select sentiment as label, (select sentiment from majority) as prediction, count(*) as n
  from assigned where split = 'validation' group by 1),
s as (select {SUMMARY} from ({class_scores('pairs')}))
select (select sentiment from majority) as baseline, round(accuracy, 6) as accuracy,
  round(f1_weighted, 6) as f1_weighted, round(precision_weighted, 6) as precision_weighted,
  round(recall_weighted, 6) as recall_weighted, n_rows from s""",
        "baseline_margin": ctes(evaluation_ctes())
        + """ select round(accuracy, 6) as accuracy, round(f1_weighted, 6) as f1_weighted,
  round(precision_weighted, 6) as precision_weighted, round(recall_weighted, 6) as recall_weighted,
  n_rows, baseline_prediction, round(baseline_accuracy, 6) as baseline_accuracy,
  round(baseline_f1_weighted, 6) as baseline_f1_weighted,
  round(accuracy_over_baseline, 6) as accuracy_over_baseline from evaluation""",
        "roc_curve": ctes(SCORED, SCORED_POINTS)
        + """ select 1e9::double as threshold, 0::double as fpr, 0::double as tpr union all
select round(score, 6), round(fps::double / n, 6), round(tps::double / p, 6) from points
where place = 1 or next_pos is null or next_pos <> pos or next_neg <> neg""",
        "roc_auc": ctes(SCORED, SCORED_POINTS) + " select round(roc_auc, 9) as roc_auc from areas",
        "pr_curve": ctes(SCORED, SCORED_POINTS)
        + """ select null::double as threshold, 1::double as precision, 0::double as recall
union all select round(score, 6), round(tps::double / (tps + fps), 6), round(tps::double / p, 6)
from points""",
        "pr_auc": ctes(SCORED, SCORED_POINTS) + " select round(pr_auc, 9) as pr_auc from areas",
        "curve_areas_lineitem": ctes(
            "sold as (select case when l_returnflag = 'R' then 'returned' else 'kept' end as label, "
            "l_extendedprice as score from lineitem)",
            score_ctes("sold", "label", "score", "returned"),
        )
        + " select round(roc_auc, 9) as roc_auc, round(pr_auc, 9) as pr_auc from areas",
        "cv_summary": ctes(SCORED, folds_ctes("scored", "label", "row_id", 5))
        + f""", {pairs('folded', 'fold')},
s as (select fold, {SUMMARY} from ({class_scores('pairs', 'fold')}) group by fold)
select round(avg(f1_weighted), 6) as cv_mean, round(stddev_pop(f1_weighted), 6) as cv_std,
  count(*) as folds from s""",
        "latency_summary": ctes(LOG, LATENCY) + " select * from latency",
        "promotion_gate": promotion_gate(),
        "golden_check": golden_check(),
        "word_count_histogram": ctes(REVIEWS, DERIVED)
        + """, b as (select min(word_count)::double as lo, max(word_count)::double as hi from derived),
binned as (select len(list_filter(range(1, 30),
  lambda i: word_count >= lo + i * ((hi - lo) / 30))) as bucket from derived, b)
select g.bucket::int as bucket, round(lo + g.bucket * ((hi - lo) / 30), 6) as low,
  round(case when g.bucket = 29 then hi else lo + (g.bucket + 1) * ((hi - lo) / 30) end, 6) as high,
  count(binned.bucket) as n
from (select unnest(range(30)) as bucket) g cross join b left join binned using (bucket)
group by all""",
        "psi": ctes(values_cte("events", ["value"], "ts", EVENTS_CUT), PSI)
        + """ select "column", n0 as n_reference, n1 as n_current, round(psi, 9) as psi
from psi join bounds using ("column")""",
        "ks_statistic": ctes(values_cte("events", ["value"], "ts", EVENTS_CUT), KS)
        + """ select "column", round(ks_statistic, 9) as ks_statistic,
  round(ks_pvalue, 9) as ks_pvalue from ks""",
        "drift_report": ctes(
            values_cte("lineitem", LINEITEM_NUMBERS, "l_shipdate", SHIP_CUT), PSI, KS
        )
        + """ select "column", round(ks_statistic, 9) as ks_statistic,
  round(ks_pvalue, 9) as ks_pvalue, round(psi, 9) as psi, psi <= 0.2 as passed
from psi join ks using ("column")""",
        "gate_report_audit": gate_report_audit(),
        "lineage_audit": lineage_audit(),
        "dimension_audit": dimension_audit(),
        "registry_state": ctes(REGISTRY) + " select * from entries",
        "registry_illegal_transitions": ctes(REGISTRY)
        + " select event_id, model, version, new_stage, reason from judged where reason is not null",
        "production_model": ctes(REGISTRY)
        + """ select model, arg_max(version, version_number) as version,
  max(version_number) as version_number from state where stage = 'production' group by model""",
        "serving_eligibility": ctes(REGISTRY)
        + """, wanted as (select event_id, case when event_id % 97 = 0 then '../outside' else
  'model-' || (user_id % 20)::varchar || '/v' || (event_id % 9)::varchar end as bundle_path
  from events)
select event_id, bundle_path, case when starts_with(bundle_path, '..') then 'outside_registry'
  when stage is null then 'unknown' when stage <> 'production' then 'not_production'
  else 'eligible' end as status
from wanted left join entries using (bundle_path)""",
        "request_validation": f"""with r as ({request_rows()}),
b as (select batch_id, count(*) as size, count(*) - count(text) as nulls from r
  where batch_id is not null group by 1)
select channel, request_id, reason is null as accepted, reason
from (select channel, request_id, case when r.batch_id is null then
    case when text is null then 'missing_text' when text = '' then 'empty_text' end
  when nulls > 0 then 'missing_text' when size > 100 then 'batch_too_large' end as reason
  from r left join b on r.batch_id = b.batch_id)""",
        "feature_override": f"""select conv_id, turn, coalesce(case when turn % 2 = 0 then conv_id % 50
  end, length(text))::bigint as review_length,
  len(regexp_extract_all(text, '[^{WHITESPACE}]+'))::int as word_count, 0::int as stars
from conversations""",
        "prediction_log_projection": """select event_id, ts, length(props)::int as text_length,
  event_type as prediction, 0.5::double as confidence, value as latency_ms from events""",
        "recent_log_metrics": ctes(LOG)
        + """, recent as (select * from log order by ts desc, event_id desc limit 100)
select count(*) as window_size, round(avg(latency_ms), 3) as recent_avg_latency_ms,
  round(quantile_cont(latency_ms, 0.95), 3) as recent_p95_latency_ms,
  (select count(*) from log) as total_predictions from recent""",
        "recent_label_distribution": ctes(LOG)
        + """ select prediction, count(*) as n from
  (select * from log order by ts desc, event_id desc limit 100) group by 1""",
        "stream_log_metrics": ctes(LOG)
        + """ select ts::date as day, prediction, count(*) as n, round(avg(latency_ms), 6) as mean,
  round(quantile_cont(latency_ms, 0.95), 6) as p95 from log group by 1, 2""",
        "stream_totals": "select event_type as prediction, count(*) as total from events group by 1",
        "stream_recent_log": ctes(LOG)
        + " select * from log order by ts desc, event_id desc limit 500",
    }
