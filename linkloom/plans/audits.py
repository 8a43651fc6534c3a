"""Queries of audits, rules, feature preparation, error categories and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from linkloom.functions import text as T
from linkloom.operators import audit as A
from linkloom.operators import blocking as B
from linkloom.operators import evaluate as V
from linkloom.operators import evidence as W
from linkloom.operators import features as X
from linkloom.operators import profile as R
from linkloom.operators import rules as U
from linkloom.plans.decisions import PC, P
from linkloom.plans.records import CORE_SQL, LISTS, RESCORE, _phon_sql, _ranked, _slim, _true_ranks
from linkloom.plans.registry import query
from linkloom.sources.entities import RECORDS_SQL, TRUTH_SQL, pairs, read, records, true_counts, truth
from linkloom.sources.tables import materialized

E = f"with {RECORDS_SQL}"
ET = f"with {RECORDS_SQL}, {TRUTH_SQL}"


@query("split_crosstab", f"""{PC},
s as (select c.s1_id, o_orderpriority as country, case when n_true = 0 then '0' when n_true = 1 then '1' when n_true <= 3 then '2-3' else '4+' end as bucket from counts c join orders on o_orderkey = c.s1_id),
r as (select *, row_number() over (partition by country, bucket order by md5(cast(s1_id as varchar)), s1_id) as i, count(*) over (partition by country, bucket) as n from s)
select country, bucket, count_if(i > round_even(n * 0.2, 0)) as train, count_if(i <= round_even(n * 0.2, 0)) as val from r group by 1, 2""")
def _(spark, d):
    s1 = true_counts(spark, d).join(read(spark, d, "orders").select(F.col("o_orderkey").alias("s1_id"), F.col("o_orderpriority").alias("country")), "s1_id")
    strata = s1.withColumn("bucket", R.match_bucket(F.col("n_true"))).withColumn("stratum", F.concat_ws("|", "country", "bucket"))
    return A.split_crosstab(V.stratified_split(strata, "stratum", 0.2), "country", "bucket")


def _audit_sql(field: str, tokens: str) -> str:
    folded, gone = f"array_to_string({tokens}, ' ')", LISTS(T.MISSING_FOLDED)
    rules = {"ampersand": f"contains({field}, '&')", "apostrophe": f"regexp_matches({field}, '[''’‘ʼ`´]')", "non_ascii": f"not regexp_full_match({field}, '[\\x00-\\x7F]*', 's')", "upper_case": f"lower({field}) <> {field}", "digit": f"regexp_matches({field}, '[0-9]')"}
    touched = " union all ".join(f"select 'touched' as section, '{field}' as field, '{name}' as value, count_if(coalesce({c}, false)) as n from rec" for name, c in rules.items())
    return f"""select 'missing' as section, '{field}' as field, value, count(*) as n from (select case when trim(coalesce({field}, '')) = '' then 'blank' when list_contains({gone}, {folded}) then 'placeholder' end as value from rec) where value is not null group by 3
union all select * from (select 'value', '{field}', {folded} as v, count(*) as n from rec where not list_contains({gone}, {folded}) group by 3 order by n desc, v limit 30)
union all select * from (select 'sign', '{field}', v, count(*) as n from (select unnest(regexp_extract_all(coalesce({field}, ''), '[\\p{{P}}\\p{{S}}]')) as v from rec) group by 3 order by n desc, v limit 40)
union all {touched}"""


#: Compounds as the columns find them: runs are taken with the sign before them, so that none starts inside a word.
COMPOUNDS = r"list_distinct(list_transform(regexp_extract_all(lower(coalesce(address, '')), '(?:^|[^\p{L}\p{N}_])([0-9]+[a-z]?(?:\s*[-/]\s*[0-9]+[a-z]?)+)(?:$|[^\p{L}\p{N}_])', 1), lambda x: replace(regexp_replace(x, '\s+', '', 'g'), '/', '-')))"


@query("cleaning_audit", f"""{E}, comp as (select country, unnest({COMPOUNDS}) as v from rec), cc as (select country, v, count(*) as n from comp group by 1, 2)
{_audit_sql("name", "nt")} union all {_audit_sql("address", "ad")}
union all select 'compound:' || country, 'address', v, n from (select *, row_number() over (partition by country order by n desc, v) as r from cc) where r <= 15""")
def _(spark, d):
    return A.cleaning_audit(records(spark, d))


@query("mining_counters", f"""{ET}, p as (select a.country, a.nt as x, b.nt as y from truth t join rec a on a.entity_id = t.s1_id join rec b on b.entity_id = t.matched_id),
u as (select country, unnest(list_distinct(list_concat(x, y))) as token, 1 as present, 0 as dropped from p
union all select country, unnest(list_distinct(list_concat(list_filter(x, lambda v: not list_contains(y, v)), list_filter(y, lambda v: not list_contains(x, v))))), 0, 1 from p)
select country, token, cast(sum(present) as bigint) as present, cast(sum(dropped) as bigint) as dropped from u group by 1, 2""")
def _(spark, d):
    rec = records(spark, d)
    a = rec.select(F.col("entity_id").alias("s1_id"), "country", F.col("name_tokens").alias("a"))
    b = rec.select(F.col("entity_id").alias("matched_id"), F.col("name_tokens").alias("b"))
    return A.mining_counters(truth(spark, d).select("s1_id", "matched_id").join(a, "s1_id").join(b, "matched_id"))


@query("dropped_words", f"""{E}, p as (select a.country, a.nt as x, b.nt as y from rec a join rec b on a.country = b.country and a.ad = b.ad and len(a.ad) > 0 and a.source = 1 and b.source > 1),
u as (select country, unnest(list_distinct(list_concat(x, y))) as token, 1 as present, 0 as dropped from p
union all select country, unnest(list_distinct(list_concat(list_filter(x, lambda v: not list_contains(y, v)), list_filter(y, lambda v: not list_contains(x, v))))), 0, 1 from p)
select country, token, cast(sum(present) as bigint) as present, cast(sum(dropped) as bigint) as dropped from u group by 1, 2""")
def _(spark, d):
    """The same counters over pairs at one address, whose names do differ."""
    rec = records(spark, d).filter(F.size("address_tokens") > 0)
    return A.counters_by_key(rec, F.array_join("address_tokens", " "), "name_tokens")


@query("precision_by_flag", f"""{P}, f as (select p >= 0.5 as pred, label, unnest([{{'flag': 'open', 'on': grp = 1}}, {{'flag': 'sure', 'on': p >= 0.8}}, {{'flag': 'doubtful', 'on': p between 0.4 and 0.6}}, {{'flag': 'all', 'on': true}}]) as x from pairs)
select x.flag as flag, count_if(pred) as n_pred, round(count_if(pred and label = 1) / nullif(count_if(pred), 0), 6) as precision, count_if(label = 1) as n_true, round(count_if(pred and label = 1) / nullif(count_if(label = 1), 0), 6) as recall from f where x.on group by 1""")
def _(spark, d):
    p = F.col("p")
    return A.precision_by_flag(pairs(spark, d).withColumn("pred", p >= 0.5), {"open": F.col("grp") == 1, "sure": p >= 0.8, "doubtful": p.between(0.4, 0.6), "all": F.lit(True)})


@query("rule_dispatch", f"""{P}, h as (select *, case when row_number() over (partition by cand_id order by p desc, s1_id) = 1 then p else 0.0 end as q from pairs)
select 'plain' as rule, s1_id, cand_id from pairs where p >= 0.6 union all select 'grouped', s1_id, cand_id from pairs where case when grp = 1 then p >= 0.7 else p >= 0.4 end union all select 'hard', s1_id, cand_id from h where q >= 0.5""")
def _(spark, d):
    df = pairs(spark, d)
    rules = {"plain": U.Rule(t0=0.6), "grouped": U.Rule(t0=0.4, t1=0.7), "hard": U.Rule(one_to_one="hard")}
    parts = [U.apply_rule(df, r).filter("pred").select(F.lit(name).alias("rule"), "s1_id", "cand_id") for name, r in rules.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _moved_sql(name: str, group: int, other: str) -> str:
    """Macro F0.5 for every threshold of one group while the other group's is `other`."""
    return f"""{name} as (select t, round(avg(case when n_true = 0 then case when npred = 0 then 1.0 else 0.0 end when npred = 0 then 0.0 else 1.25 * tp / (0.25 * n_true + npred) end), 6) as f05 from (
select c.s1_id, g.t, n_true, coalesce(any_value(x.tp), 0) + coalesce(sum(m.label), 0) as tp, coalesce(any_value(x.np), 0) + count(m.s1_id) as npred from counts c cross join grid g
left join (select s1_id, sum(label) as tp, count(*) as np from pairs where grp <> {group} and p >= {other} group by 1) x on x.s1_id = c.s1_id left join pairs m on m.s1_id = c.s1_id and m.grp = {group} and m.p >= g.t group by 1, 2, 3) group by 1)"""


_BEST = "(select t from {0} order by f05 desc, t limit 1)"


@query("tune_grouped", f"""{PC}, grid as (select round(0.05 + 0.025 * unnest(range(37)), 3) as t), {_moved_sql("m0", 0, "0.5")}, {_moved_sql("m1", 1, _BEST.format("m0"))}, {_moved_sql("m2", 0, _BEST.format("m1"))}
select cast(t as double) as t0, cast({_BEST.format("m1")} as double) as t1, f05 from m2 order by f05 desc, t limit 1""")
def _(spark, d):
    t0, t1, f05 = U.tune_grouped(pairs(spark, d), true_counts(spark, d))
    return spark.range(1).select(F.lit(t0).alias("t0"), F.lit(t1).alias("t1"), F.lit(f05).alias("f05"))


@query("calibrate_by_group")
def _(spark, d):
    return U.calibrated_by_group(pairs(spark, d)).select("s1_id", "cand_id", F.round("p", 6).alias("p"))


@query("prepared_features", """select o_orderkey, cast(coalesce(try_cast(left(o_orderpriority, 1) as double), 0) as float) as priority, cast(coalesce(try_cast(o_orderstatus as double), 0) as float) as status, cast(case when o_totalprice > 100000 then 1 else 0 end as float) as dear, cast(coalesce(o_totalprice, 0) as float) as price,
cast(o_custkey & 1 as float) as bit_0, cast((o_custkey >> 1) & 1 as float) as bit_1 from orders""")
def _(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") > 100000).alias("dear"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("passes"))
    return X.prepare(o, ["o_orderkey"], {"bit_0": 0, "bit_1": 1})


_BASE = ["stage1_score", "stage1_score_gap", "stage1_rank", "cos_name", "number_agree"]
_SETS = {"all": _BASE, "no_stage1": _BASE[3:], "rel_stage1": [*_BASE[2:], "s1rel_ratio", "s1rel_z"]}


@query("feature_sets", "select * from (values " + ", ".join(f"('{k}', '{f}')" for k, fs in _SETS.items() for f in fs) + ") t(name, feature)")
def _(spark, d):
    return spark.createDataFrame([(k, f) for k in _SETS for f in X.feature_set(k, _BASE)], "name string, feature string")


@query("profile_fold", f"{E} select entity_id, replace(strip_accents(lower(name)), 'ß', 'ss') as folded from ent")
def _(spark, d):
    from linkloom.functions.unicode import profile_fold

    return records(spark, d).select("entity_id", profile_fold("name").alias("folded"))


#: Pairs of the ranked candidates with both parsed records, and the sound keys of their core words.
_PHON = f"list_distinct(list_filter(list_transform({{0}}, lambda t: case when regexp_full_match(t, '[a-z]{{{{3,}}}}') then {_phon_sql('t').replace('{', '{{').replace('}', '}}')} end), lambda x: x is not null and length(x) >= 2))"
SIGNALS = f"""{RESCORE}, {TRUTH_SQL}, {CORE_SQL}, sg as (select *, {_PHON.format("core")} as phon from ps)"""
_ANY = "len(list_intersect(list_distinct(x.{0}), y.{0})) > 0"
_JACCARD = "case when len(list_distinct(list_concat(x.{0}, y.{0}))) > 0 and len(x.{0}) > 0 and len(y.{0}) > 0 then len(list_intersect(list_distinct(x.{0}), y.{0})) / len(list_distinct(list_concat(x.{0}, y.{0}))) else 0 end"


@query("miss_categories", f"""{SIGNALS}, m as (select t.s1_id, t.matched_id, k.rank from truth t left join k on k.s1_id = t.s1_id and k.cand_id = t.matched_id where k.rank is null or k.rank >= 1),
z as (select m.rank is not null as ranked_out, x.akey <> '' and x.akey = y.akey as same_address, y.address is null as no_address, {_ANY.format("core")} or {_ANY.format("phon")} as name, {_ANY.format("addr")} as addr from m join sg x on x.entity_id = m.s1_id join sg y on y.entity_id = m.matched_id)
select case when ranked_out and same_address then 'ranked_out_same_address' when ranked_out then 'ranked_out' when no_address and name then 'addr_missing_name_overlap' when no_address then 'addr_missing_no_name_overlap'
when not name and addr then 'name_changed_address_only' when not name then 'no_shared_word' when not addr then 'name_only_address_differs' else 'weak_name_and_address' end as category, count(*) as n from z group by 1""")
def _(spark, d):
    """True pairs that are not first in their S1's list; all scripts are Latin in these tables, which the SQL relies on."""
    from linkloom.functions.represent import romanized

    rec = W.parsed(records(spark, d))
    found = _true_ranks(spark, d).select("s1_id", "cand_id", "rank")
    missed = truth(spark, d).select("s1_id", F.col("matched_id").alias("cand_id")).join(found, ["s1_id", "cand_id"], "left").filter("rank is null or rank >= 1")
    scripts = romanized(rec.select("entity_id", "name"), "name", "name").select("entity_id", "name_script")
    named = W.compared(missed, rec, W.signals)
    named = named.join(scripts.select(F.col("entity_id").alias("s1_id"), F.col("name_script").alias("a_script")), "s1_id").join(scripts.select(F.col("entity_id").alias("cand_id"), F.col("name_script").alias("b_script")), "cand_id")
    return named.groupBy(W.miss_category(F.col("rank").isNotNull(), F.col("a_script") != F.col("b_script")).alias("category")).agg(F.count("*").alias("n"))


_NUMBERS = "len(x.nums) > 0 and len(y.nums) > 0 and len(list_intersect(x.nums, y.nums)) = 0"


@query("error_categories", f"""{SIGNALS}, tn as (select s1_id, count(*) as n_true from truth group by 1),
z as (select k.s1_id, k.rank, case when t.s1_id is null then 0 else 1 end as label, k.rank = 0 and k.priority >= 0.3 as pred, coalesce(tn.n_true, 0) as n_true, y.address is null as no_address, {_ANY.format("core")} or {_ANY.format("phon")} as link, {_JACCARD.format("core")} as nr, {_JACCARD.format("addr")} as ar, {_ANY.format("addr")} as addr, {_NUMBERS} as clash
from k join sg x on x.entity_id = k.s1_id join sg y on y.entity_id = k.cand_id left join truth t on t.s1_id = k.s1_id and t.matched_id = k.cand_id left join tn on tn.s1_id = k.s1_id),
ec as (select *, case when label = 1 and not pred then 'fn' when label = 0 and pred then 'fp' end as kind, case when no_address and (link or nr >= 0.8) then 'addr_missing_name_similar' when no_address then 'addr_missing_name_different' when not (link or nr >= 0.8) and addr then 'name_replaced_address_links'
when nr >= 0.9 and ar < 0.5 then 'same_name_other_address' when clash then 'number_conflict' else 'similar_name_and_address' end as category from z)
select kind, category, count(*) as n, count_if(n_true = 0) as on_singleton, round(avg(rank), 6) as mean_rank from ec where kind is not null group by 1, 2""")
def _(spark, d):
    """Errors of the rule "the first candidate, if its priority is 0.3 or more" over all ranked candidates; word Jaccards stand for the string ratios."""
    rec, t = _slim(spark, d), truth(spark, d)
    pred = (F.col("rank") == 0) & (F.col("priority") >= 0.3)
    label = t.select("s1_id", F.col("matched_id").alias("cand_id"), F.lit(1).alias("label"))
    ranked, alike = _ranked(spark, d, rec)
    ranked = materialized(ranked.select("country", "s1_id", "cand_id", "rank", "priority"))
    # errors only; label and prediction agree on nearly all pairs
    fn = B.looked_up(label, ranked, alike).filter(~pred)
    fp = B.for_all(ranked.filter(pred), alike).drop("country").join(label.drop("label"), ["s1_id", "cand_id"], "left_anti").withColumn("label", F.lit(0))
    both = lambda x: W.loop_features(x).join(W.signals(x).select("s1_id", "cand_id", "core_any", "phon_any", "addr_any"), ["s1_id", "cand_id"])
    errors = materialized(fn.unionByName(fp))
    # the records of errors only; what is parsed of a record follows from its words
    ids = errors.select(F.col("s1_id").alias("entity_id")).unionByName(errors.select(F.col("cand_id").alias("entity_id"))).distinct()
    words = F.concat_ws("\n", F.array_join("name_tokens", " "), F.array_join("address_tokens", " "), F.col("missing").cast("string"))
    known = rec.join(ids, "entity_id", "left_semi").withColumns({"text": words, "address": F.when(~F.col("missing"), "")})
    x = W.compared(errors, materialized(W.parsed(known)), both)
    x = x.join(t.groupBy("s1_id").agg(F.count("*").alias("n_true")), "s1_id", "left").na.fill(0, ["n_true"])
    category = A.error_category(F.col("core_any") | F.col("phon_any"), F.col("name_jaccard"), F.col("address_jaccard"), F.col("addr_any").cast("int"), F.col("number_conflict") == 1, F.col("no_address_cand") == 1, F.lit(False))
    return A.error_report(x.withColumn("category", category).withColumn("pred", pred))


@query("ready_verdict", f"""{E}, g as (select case when violations = 0 then 'PASS' when gate = 'empty_name' then 'WARN' else 'FAIL' end as level from (select unnest(['unique_ids', 'prefix', 'empty_name']) as gate, unnest([count(*) - count(distinct entity_id), count_if(not starts_with(entity_id, 'S' || source || '-')), count_if(len(nt) = 0)]) as violations from rec))
select count_if(level = 'PASS') as passed, count_if(level = 'WARN') as warned, count_if(level = 'FAIL') as failed, case when count_if(level = 'FAIL') = 0 then 'READY' else 'NOT READY' end as verdict from g""")
def _(spark, d):
    return A.gate_verdict(R.gates(records(spark, d)))


@query("config_gates")
def _(spark, d):
    words = {"legal": T.LEGAL, "honorific": T.HONORIFIC, "connector": T.CONNECTOR, "alias": T.ALIAS}
    return A.config_gates(spark, words, {"name": T.NAME_ABBREVIATIONS, "address": T.ADDRESS_ABBREVIATIONS})
