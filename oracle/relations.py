"""The input relations as DuckDB CTEs over the provided tables."""

# The country, channel, plan, rule and status values below are fixed values that both sides share.
RELATIONS = {
    "txn": """
        select l_orderkey * 10 + l_linenumber as txn_id,
               l_orderkey as account_id,
               if(l_linenumber = 7 and l_suppkey % 10 = 0, null, l_suppkey) as merchant_id,
               if(l_quantity = 50, null, l_shipdate) as txn_ts_parsed,
               if(l_quantity = 50, null, date_trunc('month', l_shipdate)::date) as txn_month,
               case l_linenumber % 4
                   when 0 then 'ONLINE' when 1 then 'POS' when 2 then 'ATM' else 'MOBILE'
               end as channel,
               case l_returnflag
                   when 'A' then 'PURCHASE' when 'N' then 'TRANSFER' when 'R' then 'WITHDRAWAL'
               end as txn_type,
               case round(l_tax * 100)::int
                   when 0 then 'DECLINED' when 1 then 'FAILED' when 2 then 'REVERSED'
                   else 'SETTLED'
               end as status,
               l_extendedprice::decimal(12, 2) as amount_usd,
               (l_orderkey * 31 + l_partkey * 7 + l_linenumber) % 50 = 0 as is_fraud,
               if(l_returnflag = 'R' and l_linenumber = 7, l_orderkey * 10 + 1, null)
                   as reversal_of_txn_id
        from lineitem""",
    "acct": "select o_orderkey as account_id, o_custkey as customer_id from orders",
    "cust": """
        select c_custkey as customer_id, c_mktsegment as risk_segment, n_name as country
        from customer join nation on c_nationkey = n_nationkey""",
    "merch": """
        select s_suppkey as merchant_id, if(s_suppkey % 7 = 0, null, s_name) as merchant_name,
               'CITY_' || s_nationkey as city, n_name as country
        from supplier join nation on s_nationkey = n_nationkey""",
    "header": """
        select o_orderkey as oid, o_custkey as cid, o_orderdate::date as day,
               date_trunc('month', o_orderdate)::date as month,
               (o_custkey % 10 + 1)::int as territory,
               o_orderpriority in ('1-URGENT', '2-HIGH') as online
        from orders""",
    "line": """
        select l_orderkey as oid,
               l_extendedprice::decimal(12, 2) * (1 - l_discount::decimal(4, 2)) as line_total,
               round(l_discount * 100) > 5 as discounted
        from lineitem""",
    # per order: revenue, and the share of discounted lines in millionths
    "fact": """
        select h.*, sum(line_total) as revenue,
               (2000000 * count(*) filter (discounted) + count(*)) // (2 * count(*)) as share_e6
        from header h join line using (oid)
        group by all""",
    "ctype": """
        select c_custkey as cid,
               case when c_mktsegment in ('HOUSEHOLD', 'AUTOMOBILE') then 'Individual'
                    when c_mktsegment in ('BUILDING', 'MACHINERY') then 'Store'
                    else 'Unknown' end as kind
        from customer""",
    "plan": """
        select * from (values (1, 'Free', 0.00), (2, 'Basic', 19.00), (3, 'pro', 49.00),
                              (4, 'Business', 99.00)) v(plan_id, plan_name, price)""",
    "sub": """
        select o_orderkey as subscription_id, o_custkey as user_id,
               (o_orderkey % 4 + 1)::int as plan_id, o_orderdate::date as start_date,
               if(o_orderkey % 10 < 3,
                  o_orderdate::date + (30 + o_orderkey % 120)::int, null) as end_date,
               case o_orderstatus when 'F' then 'CANCELLED' when 'O' then 'ACTIVE'
                                  when 'P' then 'PAST_DUE' end as status
        from orders""",
    "pay": """
        select subscription_id, start_date + 30 as payment_date, price as amount,
               case when subscription_id % 19 = 0 then 'FAILED'
                    when subscription_id % 23 = 0 then 'REFUNDED' else 'PAID' end as status
        from sub join plan using (plan_id) where price > 0""",
    "kpi": """
        select date_trunc('week', txn_ts_parsed)::date as week_start, channel,
               count(*) as attempted_txns,
               count(*) filter (status = 'SETTLED') as settled_txns,
               count(*) filter (status = 'DECLINED' or status = 'FAILED') as declined_txns,
               count(*) filter (is_fraud) as fraud_txns,
               sum(amount_usd) as attempted_usd,
               (20000 * declined_txns + attempted_txns) // (2 * attempted_txns) as declined_e2,
               (20000 * fraud_txns + attempted_txns) // (2 * attempted_txns) as fraud_e2
        from txn where txn_ts_parsed is not null
        group by 1, 2""",
    "trend": """
        select *, lag(attempted_txns) over w as prev_txns, lag(attempted_usd) over w as prev_usd,
               lag(declined_e2) over w as prev_declined_e2, lag(fraud_e2) over w as prev_fraud_e2
        from kpi window w as (partition by channel order by week_start)""",
    "long": """
        select week_start, channel, 'fraud_rate_pct' as kpi_name, fraud_e2 as e2 from kpi
        union all by name
        select week_start, channel, 'declined_rate_pct' as kpi_name, declined_e2 as e2 from kpi""",
    "rule": """
        select * from (values
            ('fraud_rate_pct', 'GLOBAL', null, 'Risk', 120, '<=', 'HIGH'),
            ('declined_rate_pct', 'GLOBAL', null, 'Payments', 800, '<=', 'MED'),
            ('fraud_rate_pct', 'CHANNEL', 'ONLINE', 'Risk', 90, '<=', 'HIGH'))
        v(kpi_name, scope, rule_channel, owner_team, target_e2, comparator, severity)""",
    "matched": """
        select long.*, rule.* exclude (kpi_name, rule_channel)
        from long join rule
          on long.kpi_name = rule.kpi_name
         and (rule_channel is null or rule_channel = long.channel)
        qualify row_number() over (partition by week_start, channel, long.kpi_name
                                   order by scope = 'GLOBAL') = 1""",
    "board": """
        select *, if(e2 <= target_e2, 'PASS', 'FAIL') as sla_status, e2 - target_e2 as breach_e2
        from matched""",
    "recent": """
        select * from txn
        where txn_month >= (select max(txn_month) from txn) - interval 11 months""",
    "base": """
        select recent.*, customer_id,
               coalesce(merchant_name, 'merchant_id=' || merchant_id) as merchant_name,
               city, country
        from recent join acct using (account_id) left join merch using (merchant_id)
        where merchant_id is not null and txn_ts_parsed is not null""",
    "repeats": """
        select merchant_id, count(*) as customers_with_settled,
               count(*) filter (n >= 2) as repeat_customers
        from (select merchant_id, customer_id, count(*) as n
              from base where status = 'SETTLED' group by all)
        group by merchant_id""",
    "merchant": """
        select merchant_id, any_value(merchant_name) as merchant_name, any_value(city) as city,
               any_value(country) as country,
               count(*) as attempted_txns, sum(amount_usd) as attempted_usd,
               count(*) filter (status = 'SETTLED') as settled_txns,
               coalesce(sum(amount_usd) filter (status = 'SETTLED'), 0) as settled_usd,
               count(*) filter (status in ('DECLINED', 'FAILED')) as declined_txns,
               coalesce(sum(amount_usd) filter (status in ('DECLINED', 'FAILED')), 0)
                   as declined_usd,
               count(*) filter (back) as reversed_txns,
               coalesce(sum(amount_usd) filter (back), 0) as reversed_usd,
               count(*) filter (is_fraud) as fraud_txns,
               coalesce(sum(amount_usd) filter (is_fraud), 0) as fraud_usd,
               count(distinct customer_id) as unique_customers
        from (select *, status = 'REVERSED' or reversal_of_txn_id is not null as back from base)
        group by merchant_id""",
    "active": """
        select distinct customer_id, txn_month
        from txn join acct using (account_id) join cust using (customer_id)
        where status = 'SETTLED' and txn_ts_parsed is not null""",
    "cohorts": "select customer_id, min(txn_month) as cohort_month from active group by 1",
    "sizes": "select cohort_month, count(*) as cohort_size from cohorts group by 1",
    "retained": """
        select cohort_month, datediff('month', cohort_month, txn_month) as month_number,
               cohort_size, count(distinct customer_id) as active_customers,
               (20000 * active_customers + cohort_size) // (2 * cohort_size) as retention_e2
        from active join cohorts using (customer_id) join sizes using (cohort_month)
        group by cohort_month, month_number, cohort_size""",
    "firsts": "select cid, min(month) as cohort from fact group by cid",
    "months": """
        select fact.*, cohort, datediff('month', cohort, month) as idx
        from fact join firsts using (cid)
        where idx between 0 and 12""",
    "draw_user": """
        select c_custkey as user_id,
               date '2024-01-01' + {day}::int as signup_date,
               ['US', 'UK', 'IN', 'CA', 'DE'][{country} + 1] as country,
               ['Organic', 'Paid Search', 'Referral', 'outbound'][{channel} + 1]
                   as acquisition_channel
        from customer""",
    "draw_sub": """
        select user_id as subscription_id, user_id,
               case when {plan1} < 4 then 1 when {plan2} < 7 then 2 when {plan3} < 9 then 3
                    else 4 end as plan_id,
               signup_date as start_date,
               if({ends} < 3, signup_date + (30 + {end_days})::int, null) as end_date,
               if({cancelled} < 3, 'CANCELLED', 'ACTIVE') as status
        from draw_user""",
    "member": """
        select c_custkey as user_id, min(o_orderdate)::date as signup_date,
               any_value(n_name) as country, any_value(c_mktsegment) as acquisition_channel
        from customer join nation on c_nationkey = n_nationkey
                      left join orders on o_custkey = c_custkey
        group by all""",
    "usage": """
        select event_id as usage_id, user_id, event_type as feature_name, ts::date as usage_date,
               floor(value)::int as usage_count
        from events""",
    "saver": """
        select c_custkey as account_key, abs(c_acctbal) as principal,
               (c_custkey % 11 - 2)::double * 0.01::double as annual_return,
               (c_custkey % 7 * 50)::double * if(c_custkey % 2 = 0, 12, 1) as paid_per_year,
               [252, 12, 1][c_custkey % 3 + 1] as per_year,
               (c_custkey % 13)::double * 0.005::double as inflation,
               if(c_custkey // 2 % 2 = 0, 1, 0) as upfront,
               (c_custkey % 5 + 1) * per_year as periods,
               abs(c_acctbal) * 1.5::double as goal
        from customer""",
    "rates": """
        select *, pow(1 + annual_return, 1.0::double / per_year) - 1 as r,
               pow(1 + inflation, 1.0::double / per_year) - 1 as infl,
               paid_per_year / per_year as paid
        from saver""",
    # ((1 + r) ^ t - 1) / r for t = period - 1, with the digits that subtracting 1 would lose
    "growths": """
        select *, if(e = 1, power_log, (e - 1) * power_log / ln(e)) / r as annuity
        from (select *, (period - 1) * if(1 + r = 1, r, ln(1 + r) * r / ((1 + r) - 1)) as power_log,
                     exp(power_log) as e
              from (select *, unnest(range(1, periods + 1)) as period from rates))""",
    "schedule": """
        select *, period / per_year as year,
               if(r = 0, principal + paid * (period - 1),
                  principal * pow(1 + r, period - 1)
                  + paid * (1 + upfront * r) * annuity) as opening,
               (opening + upfront * paid) * r as earned,
               opening + paid + earned as closing,
               closing / pow(1 + infl, period) as real_closing
        from growths""",
}


def draw(row_id: str, stream: str, buckets: int, seed: int = 7) -> str:
    """First 32 bits of md5(id-stream-seed), modulo the number of buckets."""
    return (
        f"('0x' || substr(md5({row_id} || '-{stream}-{seed}'), 1, 8))::bigint % {buckets}"
    )


_DRAWS = {
    "draw_user": {
        "day": draw("c_custkey", "day", 365),
        "country": draw("c_custkey", "country", 5),
        "channel": draw("c_custkey", "channel", 4),
    },
    "draw_sub": {
        "plan1": draw("user_id", "plan1", 10),
        "plan2": draw("user_id", "plan2", 10),
        "plan3": draw("user_id", "plan3", 10),
        "ends": draw("user_id", "ends", 10),
        "end_days": draw("user_id", "end_days", 120),
        "cancelled": draw("user_id", "cancelled", 10),
    },
}


def with_relations(names: str, body: str) -> str:
    """``body`` preceded by the named relations, in dependency order."""
    ctes = []
    for name in names.split():
        text = RELATIONS[name]
        if name in _DRAWS:
            text = text.format(**{k: f"({v})" for k, v in _DRAWS[name].items()})
        ctes.append(f"{name} as ({text})")
    head = "with " + ",\n".join(ctes) + "\n" if ctes else ""
    return head + body
