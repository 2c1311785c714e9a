"""SQL that states the expected result of a query, run on another engine over the same tables."""

from __future__ import annotations

LOANS = """
select o_orderkey as loan_id,
 cast(floor(o_totalprice / 12e0) as int) as loan_amnt,
 case when o_orderkey % 97 = 0 then null when o_orderkey % 101 = 0 then 'months'
      when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end as term,
 case when o_orderkey % 89 = 0 then null else concat(cast(5 + o_custkey % 20 as string), '.',
      lpad(cast(o_orderkey % 100 as string), 2, '0'), '%') end as int_rate,
 o_totalprice / 432e0 as installment,
 substr('ABCDE', cast(substr(o_orderpriority, 1, 1) as int), 1) as grade,
 case when o_orderkey % 11 = 0 then 'n/a' when o_orderkey % 11 = 10 then '10+ years'
      else concat(cast(o_orderkey % 11 as string), ' years') end as emp_length,
 c_acctbal * 10e0 as annual_inc, n_name as addr_state,
 case when o_orderkey % 53 = 0 then null else (c_custkey % 400) / 10e0 end as dti,
 cast(o_orderkey % 4 as int) as delinq_2yrs, cast(c_custkey % 6 as int) as inq_last_6mths,
 case when o_orderkey % 2 = 0 then null else cast(o_orderkey % 80 as int) end as mths_since_last_delinq,
 cast(floor(abs(c_acctbal)) as int) as revol_bal,
 case when o_orderkey % 71 = 0 then null else concat(cast(c_custkey % 100 as string), '.',
      cast(o_orderkey % 10 as string), '%') end as revol_util,
 o_totalprice / 24e0 as out_prncp, o_totalprice / 20e0 as total_pymnt,
 o_totalprice / 30e0 as total_rec_prncp, o_totalprice / 60e0 as total_rec_int,
 cast(case when o_orderkey % 997 = 0 then null
      when o_totalprice > 350000 and o_orderkey % 19 = 0 then 1 + o_orderkey % 3
      else 0 end as int) as collections_12_mths_ex_med
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

NEW_TERM = "try_cast(string_split(term, ' ')[2] as int) as newTerm"
INT_RATE = "try_cast(string_split(int_rate, '%')[1] as double) as intRate"
REVOL_UTIL = "try_cast(string_split(revol_util, '%')[1] as double) as revolUtil"

CLEAN = f"""
with loans as ({LOANS}),
clean as (
  select * exclude (term, int_rate, revol_util), {NEW_TERM}, {INT_RATE}, {REVOL_UTIL} from loans
)
"""

FEATURES = f"""
{CLEAN},
labelled as (
  select loan_id,
         case when collections_12_mths_ex_med <> 0 then 1
              else collections_12_mths_ex_med end as label,
         loan_amnt, installment, annual_inc, dti, revol_bal, out_prncp, total_pymnt,
         total_rec_prncp, total_rec_int, intRate, revolUtil
  from clean
),
features as (
  select * from labelled
  where label is not null and loan_amnt is not null and installment is not null
    and annual_inc is not null and dti is not null and revol_bal is not null
    and out_prncp is not null and total_pymnt is not null and total_rec_prncp is not null
    and total_rec_int is not null and intRate is not null and revolUtil is not null
)
"""

BUCKET = """cast(
  cast('0x' || substr(md5(concat(cast(loan_id as varchar), ':784')), 1, 8) as bigint) % 10000
  as int)"""

RATIO = "(select cast(count(*) - count(*) filter (label = 0) as double) / count(*) from {rows})"


def weight(rows: str) -> str:
    ratio = RATIO.format(rows=rows)
    return f"case when label <> 0 then 1e0 - {ratio} else {ratio} end"


RULE = f"""
{FEATURES},
scores as (
  select loan_id, label, {weight("features")} as weight, cast(loan_amnt as double) as score,
         case when loan_amnt > 29166 then 1 else 0 end as prediction
  from features
)
"""

COLLECTED = f"{CLEAN} select * from clean where collections_12_mths_ex_med <> 0"


def nulls(columns: list[str], rows: str) -> str:
    return " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as null_rows from {rows}"
        for c in columns
    )


ORACLES = {
    # cleaning
    "loans_by_state": f"""{CLEAN}
        select addr_state, count(*) as count from clean
        where collections_12_mths_ex_med <> 0 group by addr_state""",
    "loan_fixture": LOANS,
    "loan_columns": f"select * exclude (loan_id) from ({LOANS})",
    "etl_clean": f"{CLEAN} select * from clean",
    "etl_term": f"select * exclude (term), {NEW_TERM} from ({LOANS})",
    "etl_keep_source": f"""
        select * exclude (term, int_rate), {NEW_TERM}, {INT_RATE}, {REVOL_UTIL} from ({LOANS})""",
    "parse_failures": f"""
        with loans as ({LOANS}),
        parsed as (select *, {NEW_TERM}, {INT_RATE}, {REVOL_UTIL} from loans)
        select 'newTerm' as column_name, count(*) as failed_rows from parsed
        where term is not null and newTerm is null
        union all
        select 'intRate', count(*) from parsed where int_rate is not null and intRate is null
        union all
        select 'revolUtil', count(*) from parsed
        where revol_util is not null and revolUtil is null""",
    "unreadable_terms": f"""
        select loan_id, term from (select *, {NEW_TERM} from ({LOANS}))
        where term is not null and newTerm is null""",
    "priority_number": """
        select o_orderkey, try_cast(string_split(o_orderpriority, '-')[1] as int) as priority_no,
               string_split(o_orderpriority, '-')[2] as priority_text
        from orders""",
    "brand_number": """
        select p_partkey, try_cast(string_split(p_brand, '#')[2] as int) as brand_no from part""",
    "customer_number": """
        select c_custkey, try_cast(string_split(c_name, '#')[2] as int) as customer_no
        from customer""",
    # filters, counts, inspection
    "count_all": f"select count(*) as row_count from ({LOANS})",
    "collections_rows": COLLECTED,
    "count_collections": f"select count(*) as row_count from ({COLLECTED})",
    "collections_text_filter": f"""
        select loan_id, cast(collections_12_mths_ex_med as varchar) as collections_12_mths_ex_med
        from ({LOANS}) where collections_12_mths_ex_med <> 0""",
    "status_counts": "select o_orderstatus, count(*) as count from orders group by o_orderstatus",
    "state_grade_counts": f"""
        select addr_state, grade, count(*) as count from ({LOANS}) group by addr_state, grade""",
    "describe_schema": f"""
        select column_name as col_name,
               case column_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int'
                                else lower(column_type) end as data_type,
               '' as comment
        from (describe {LOANS})""",
    "numeric_columns": nulls(
        [
            "loan_id", "loan_amnt", "installment", "annual_inc", "dti", "delinq_2yrs",
            "inq_last_6mths", "mths_since_last_delinq", "revol_bal", "out_prncp", "total_pymnt",
            "total_rec_prncp", "total_rec_int", "collections_12_mths_ex_med",
        ],
        f"({LOANS})",
    ),
    "non_numeric_columns": nulls(
        ["term", "int_rate", "grade", "emp_length", "addr_state", "revol_util"], f"({LOANS})"
    ),
    "first_row": """
        select o_orderkey, o_orderpriority from orders
        where o_orderkey = (select min(o_orderkey) from orders)""",
    "user_stamp": f"select count(*) as loan_rows, count(*) as stamped_rows from ({LOANS})",
    # SQL
    "sql_etl": f"{CLEAN} select * from clean",
    "sql_collections_by_state": f"""
        select addr_state, count(*) as count from ({LOANS})
        where collections_12_mths_ex_med <> 0 group by addr_state""",
    "sql_view_chain": f"select grade, count(*) as count from ({COLLECTED}) group by grade",
    "sql_join": """
        select n_name, count(*) as orders, max(o_totalprice) as largest
        from orders, customer, nation
        where o_custkey = c_custkey and c_nationkey = n_nationkey and o_orderstatus = 'F'
        group by n_name having count(*) > 1""",
    "sql_window": """
        select o_custkey, o_orderkey,
               row_number() over (partition by o_custkey order by o_orderdate, o_orderkey)
                 as order_no,
               max(o_totalprice) over (partition by o_custkey) as largest
        from orders""",
    "sql_sort_limit": """
        select o_orderkey, o_totalprice from orders
        order by o_totalprice desc, o_orderkey limit 25""",
    "sql_set_op": """
        select c_custkey as custkey from customer
        where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus = 'F')
        """,
    # sources and sinks
    "csv_roundtrip": LOANS,
    "csv_schema_roundtrip": LOANS,
    "csv_sql_view": LOANS,
    "csv_corrupt_rows": """
        select o_orderkey, cast(null as int) as o_orderpriority,
               concat(cast(o_orderkey as varchar), ',', o_orderpriority) as raw_line
        from orders""",
    "table_roundtrip": f"{CLEAN} select * from clean",
    "table_replaced": COLLECTED,
    "table_sql_view": f"{CLEAN} select * from clean",
    "partitioned_roundtrip": f"{CLEAN} select * from clean",
    "partition_filter": f"{CLEAN} select * from clean where addr_state = 'NATION_7'",
    "repartition_rows": f"""
        select addr_state, count(*) as count from ({LOANS}) group by addr_state""",
    "repartition_salted": f"{CLEAN} select * from clean",
    "ctas_roundtrip": f"{CLEAN} select * from clean",
    "ctas_at_path": f"{CLEAN} select * from clean",
    "insert_overwrite": COLLECTED,
    "enforced_write": f"{CLEAN} select * from clean",
    "required_nulls": f"{CLEAN} {nulls(['loan_id', 'newTerm', 'dti'], 'clean')}",
    "zip_landing": f"select *, cast(null as varchar) as _corrupt_record from ({LOANS})",
    "stream_etl": f"{CLEAN} select * from clean",
    "manifest_delta": """
        select o_orderkey, o_orderstatus,
               cast(case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end as bigint) as landing
        from orders""",
    "insert_overwrite_partition": f"""{CLEAN}
        select * from clean
        where addr_state not in ('NATION_3', 'NATION_7', 'NATION_11')
           or (addr_state <> 'NATION_11' and loan_amnt < 10000)""",
    "enforced_quarantine": f"""{CLEAN}
        select loan_id, loan_amnt, dti,
               coalesce(nullif(concat_ws('; ', case when dti is null then 'dti is null' end,
                                         case when newTerm is null then 'newTerm is null' end,
                                         case when loan_amnt > 30000 then 'amount above 30000' end), ''),
                        'none') as violation
        from clean""",
    "clustered_roundtrip": f"{CLEAN} select * from clean",
    "bucketed_join": f"""
        select loan_id, max(addr_state) as addr_state, count(*) as payments,
               cast(sum(cast(l_quantity as bigint)) as bigint) as quantity
        from ({LOANS}) join lineitem on l_orderkey = loan_id group by loan_id""",
    "inferred_types": """
        select 'order_no' as column_name, 'int' as inferred, 'int' as likely, count(*) as values,
               0::bigint as misfits, null::varchar as first_misfit from orders
        union all
        select 'price', case when count(*) filter (o_orderkey % 1000 = 0) > 0 then 'string' else 'double' end,
               'double', count(*), count(*) filter (o_orderkey % 1000 = 0),
               max('unknown') filter (o_orderkey % 1000 = 0) from orders
        union all
        select 'o_orderstatus', 'string', 'string', count(*), 0, null from orders
        union all
        select 'ordered', 'date', 'date', count(*), 0, null from orders
        union all
        select 'large', 'boolean', 'boolean', count(*) filter (o_orderkey % 7 <> 0), 0, null from orders""",
    "stream_state_counts": f"""{CLEAN}
        select addr_state, cast(count(*) as bigint) as count from clean
        where collections_12_mths_ex_med <> 0 group by addr_state""",
    # labels, weights, split
    "binary_labels": f"{FEATURES} select loan_id, label from labelled",
    "feature_rows": f"{FEATURES} select * from features",
    "positive_rows": f"{FEATURES} select * from features where label = 1",
    "class_share": f"""{FEATURES}
        select count(*) filter (label = 1) * 100e0 / count(*) as positive_percent from features""",
    "balancing_ratio": f"{FEATURES} select {RATIO.format(rows='features')} as balancing_ratio",
    "class_weights": f"""{FEATURES}
        select loan_id, label, {weight('features')} as classWeight from features""",
    "class_weights_train_ratio": f"""{FEATURES},
        train as (select * from features where {BUCKET} < 7000)
        select loan_id, label, {weight('train')} as classWeight from features""",
    "toxic_share": """
        select count(*) filter (toxic = 1) * 100e0 / count(*) as positive_percent from labels""",
    "toxic_weights": f"""
        with rows_ as (select doc_id, toxic as label from labels)
        select doc_id, label as toxic, {weight('rows_')} as classWeight from rows_""",
    "hash_split": f"""{FEATURES}
        select loan_id, {BUCKET} as bucket,
               case when {BUCKET} < 7000 then 'train' else 'test' end as part
        from features""",
    "random_split_whole": f"{FEATURES} select loan_id from features",
    "stratified_whole": f"{FEATURES} select * from features",
    "stratified_counts": f"""{FEATURES},
        sizes as (select label, count(*) as n from features group by label),
        parts as (
          select label, 'train' as part, n * 7 // 10 as rows from sizes
          union all select label, 'test', n - n * 7 // 10 from sizes
        )
        select label, part, cast(rows as bigint) as rows from parts where rows > 0""",
    # evaluation of given predictions
    "auroc_exact": f"""{RULE},
        per_score as (
          select score, sum(label) as pos, count(*) - sum(label) as neg from scores group by score
        ),
        ranked as (
          select pos, neg, sum(neg) over (order by score) - neg as below from per_score
        )
        select cast(sum(pos * (2 * below + neg)) as double)
               / (2 * cast(sum(pos) as double) * cast(sum(neg) as double)) as area_under_roc
        from ranked""",
    "confusion_counts": f"""{RULE}
        select label, prediction, count(*) as rows from scores group by label, prediction""",
    "precision_by_label": f"""{RULE}
        select prediction,
               cast(count(*) filter (label = prediction) as double) / count(*) as precision
        from scores group by prediction""",
    "precision_weighted": f"""{RULE}
        select prediction,
               round(sum(case when label = prediction then weight else 0e0 end) / sum(weight), 6)
                 as precision
        from scores group by prediction""",
    "precision_never_predicted": f"""{RULE}
        select 0 as prediction, round(avg(case when label = 0 then 1e0 else 0e0 end), 9) as precision
        from scores
        union all select 1, 0e0""",
    "roc_points": f"""{RULE},
        per_score as (
          select score, cast(sum(label) as double) as pos, cast(count(*) - sum(label) as double) as neg
          from scores group by score
        )
        select round(sum(neg) over upto / sum(neg) over (), 9) as fpr,
               round(sum(pos) over upto / sum(pos) over (), 9) as tpr
        from per_score window upto as (order by score desc)
        union all select 0e0, 0e0""",
    "split_without_key": f"""{FEATURES}
        select cast(count(*) as bigint) as rows, cast(1 as bigint) as most_parts from features""",
    "fraction_labels": """
        select o_orderkey,
               case when o_totalprice - floor(o_totalprice) <> 0 then 1 else 0 end as fraction_label,
               case when o_orderkey % 3 = 0 then 0 else 1 end as big_label,
               case o_orderkey % 3 when 0 then 0 when 1 then 1 end as text_label
        from orders""",
    # estimators
    "feature_vectors": f"""{FEATURES}
        select loan_id, label, cast(loan_amnt as double) as loan_amnt_value,
               installment as installment_value, annual_inc as annual_inc_value,
               dti as dti_value, cast(revol_bal as double) as revol_bal_value,
               out_prncp as out_prncp_value, total_pymnt as total_pymnt_value,
               total_rec_prncp as total_rec_prncp_value, total_rec_int as total_rec_int_value,
               intRate as intRate_value, revolUtil as revolUtil_value
        from features""",
    "dt_reload_agreement": f"""{FEATURES}
        select count(*) as scored_rows, count(*) as equal_rows from features
        where not ({BUCKET} < 7000)""",
    "dt_expression_agreement": f"""{FEATURES}
        select count(*) as scored_rows, count(*) as equal_rows from features
        where not ({BUCKET} < 7000)""",
    # A group whose majority class is that of the other group too gets the overall share:
    # the tree joins leaves that predict the same class.
    "dt_group_scores": f"""
        with rows_ as (
          select case when annual_inc > 60000 then 1 else 0 end as high_income,
                 case when revol_bal > 5000 then 1e0 else 0e0 end as label
          from ({LOANS})
        ),
        groups as (select high_income, avg(label) as share from rows_ group by high_income),
        joined as (
          select high_income,
                 case when (select count(distinct share > 0.5) from groups) > 1 then share
                      else (select avg(label) from rows_) end as score
          from groups
        )
        select high_income, round(score, 6) as score,
               case when score > 0.5 then 1 else 0 end as prediction
        from joined""",
    "flow_reload_agreement": f"""{FEATURES}
        select count(*) as scored_rows, count(*) as equal_rows from features
        where not ({BUCKET} < 7000)""",
    "lr_prediction_rows": f"""{FEATURES}
        select loan_id, label, true as by_score from features where not ({BUCKET} < 7000)""",
    "lr_enet_conditions": """
        select unnest(['loan_amnt', 'installment', 'annual_inc', 'dti', 'revol_bal', 'out_prncp',
                       'total_pymnt', 'total_rec_prncp', 'total_rec_int', 'intRate', 'revolUtil'])
                 as feature_name,
               true as holds""",
    "lr_group_scores": f"""
        with rows_ as (select quality, toxic as label from labels),
        weighted as (select quality, label, {weight('rows_')} as weight from rows_)
        select quality, round(sum(label * weight) / sum(weight), 3) as score
        from weighted group by quality""",
}
