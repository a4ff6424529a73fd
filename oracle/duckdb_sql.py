"""One DuckDB statement per registered query, written apart from the Spark code.

Rates are rounded in integer arithmetic: ``x_e2`` holds hundredths, ``x_e6``
millionths.  Decimals leave as DOUBLE, as on the Spark side.
"""

from __future__ import annotations

from oracle.relations import draw, with_relations

_KPI = "txn kpi"
_MATCHED = _KPI + " long rule matched"
_BASE = "txn acct merch recent base"
_ACTIVE = "txn acct cust active cohorts"
_ORDERS = "header line fact"
_RATES = "saver rates growths schedule"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den of non-negative integers, rounded half up to ``digits`` decimals."""
    unit = 10**digits
    return (
        f"((2 * {unit}::hugeint * ({num}) + ({den})) // nullif(2 * ({den}), 0))::double / {unit}"
    )


def signed_half_up(num: str, den: str, digits: int) -> str:
    return f"sign({num}) * ({half_up(f'abs({num})', den, digits)})"


def money(total: str) -> str:
    """A decimal(·, 4) or narrower total in ten-thousandths."""
    return f"(({total}) * 10000)::hugeint"


def _fraud(key: str) -> str:
    rate = half_up("100 * count(*) filter (is_fraud)", "count(*)", 3)
    return f"""{key}, count(*) as txns, count(*) filter (is_fraud) as fraud_txns,
               {rate} as fraud_rate_pct"""


def _kpi_columns(declined: str) -> str:
    return f"""week_start, channel, attempted_txns, settled_txns, declined_txns,
        declined_e2::double / 100 as {declined}, fraud_txns,
        fraud_e2::double / 100 as fraud_rate_pct, attempted_usd::double as attempted_usd"""


_TREND_COLUMNS = """week_start, channel, attempted_txns, attempted_usd::double as attempted_usd,
    declined_e2::double / 100 as declined_rate_pct, fraud_e2::double / 100 as fraud_rate_pct,
    prev_txns as prev_attempted_txns, prev_usd::double as prev_attempted_usd,
    prev_declined_e2::double / 100 as prev_declined_rate_pct,
    prev_fraud_e2::double / 100 as prev_fraud_rate_pct"""

_TOTALS = """merchant_id, merchant_name, city, country, attempted_txns,
    attempted_usd::double as attempted_usd, settled_txns, settled_usd::double as settled_usd"""


def _payments() -> dict[str, str]:
    average = half_up("sum(amount_usd * 100)::hugeint * 10000", "count(*)", 0)
    return {
        "a1_monthly_trend": with_relations(
            "txn",
            f"""select txn_month, count(*) as txn_count, sum(amount_usd)::double as total_usd,
                       {average} / 1000000 as avg_usd
                from txn where status = 'SETTLED' group by txn_month""",
        ),
        "a2_channel_type_mix": with_relations(
            "txn",
            """select txn_month, channel, txn_type, count(*) as txn_count,
                      sum(amount_usd)::double as total_usd
               from txn where status = 'SETTLED' group by all""",
        ),
        "a3_top_customers": with_relations(
            "txn acct cust",
            """select customer_id, risk_segment, country, count(*) as txn_count,
                      sum(amount_usd)::double as total_usd
               from txn join acct using (account_id) join cust using (customer_id)
               where status = 'SETTLED' group by all
               order by sum(amount_usd) desc, customer_id limit 50""",
        ),
        "a4_fraud_by_channel": with_relations(
            "txn", f"select {_fraud('channel')} from txn group by channel"
        ),
        "a5_fraud_by_segment": with_relations(
            "txn acct cust",
            f"""select {_fraud('risk_segment')}
                from txn join acct using (account_id) join cust using (customer_id)
                group by risk_segment""",
        ),
        "a6_merchant_risk_top": with_relations(
            "txn merch",
            f"""select merchant_name, country, txns, fraud_txns, fraud_rate_pct from (
                    select {_fraud('merchant_id, merchant_name, country')}
                    from txn join merch using (merchant_id)
                    group by merchant_id, merchant_name, country having count(*) >= 50)
                order by fraud_txns::double / txns desc, txns desc, merchant_id limit 20""",
        ),
    }


def _weekly() -> dict[str, str]:
    sunday_kpi = with_relations(
        _KPI, f"select {_kpi_columns('decline_rate_pct')} from kpi"
    ).replace(
        "date_trunc('week', txn_ts_parsed)::date",
        "txn_ts_parsed::date - dayofweek(txn_ts_parsed)::int",
    )
    return {
        "b1_weekly_kpi_report": sunday_kpi,
        "b2_weekly_kpi_channel": with_relations(
            _KPI, f"select {_kpi_columns('declined_rate_pct')} from kpi"
        ),
        "b5_merged_weekly_state": with_relations(
            _KPI,
            """select week_start, channel, attempted_txns, settled_txns, declined_txns, fraud_txns,
                      attempted_usd::double as attempted_usd
               from kpi""",
        ),
        "b3_weekly_trend": with_relations(
            _KPI + " trend", f"select {_TREND_COLUMNS} from trend"
        ),
        "b4_weekly_alerts": with_relations(
            _KPI + " trend",
            """select week_start, channel, attempted_txns,
                      declined_e2::double / 100 as declined_rate_pct,
                      fraud_e2::double / 100 as fraud_rate_pct,
                      case when attempted_txns < 50 then 'LOW_VOLUME'
                           when fraud_e2 >= prev_fraud_e2 + 50 then 'FRAUD_SPIKE'
                           when declined_e2 >= prev_declined_e2 + 200 then 'DECLINE_SPIKE'
                           else 'OK' end as alert_flag
               from trend""",
        ),
        "c2_kpi_long": with_relations(
            _KPI + " long",
            "select week_start, channel, kpi_name, e2::double / 100 as actual_value from long",
        ),
        "c3_match_rules": with_relations(
            _MATCHED,
            """select week_start, channel, kpi_name, e2::double / 100 as actual_value, owner_team,
                      target_e2::double / 100 as target_value, comparator, severity, scope
               from matched""",
        ),
        "c4_sla_scoreboard": with_relations(
            _MATCHED + " board",
            """select week_start, channel, kpi_name, e2::double / 100 as actual_value, comparator,
                      target_e2::double / 100 as target_value, owner_team, severity, sla_status,
                      breach_e2::double / 100 as breach_amount
               from board""",
        ),
        "c5_sla_breach_summary": with_relations(
            _MATCHED + " board",
            f"""select kpi_name, owner_team, severity, count(*) as total_rows,
                       count(*) filter (sla_status = 'FAIL') as breaches,
                       {half_up("100 * count(*) filter (sla_status = 'FAIL')", "count(*)", 2)}
                           as breach_rate_pct
                from board group by all""",
        ),
    }


def _merchants() -> dict[str, str]:
    score = signed_half_up(
        "100::hugeint * attempted_txns * settled_txns"
        " - 100::hugeint * (2 * fraud_txns + declined_txns) * settled_txns"
        " - 100::hugeint * reversed_txns * attempted_txns",
        "attempted_txns * settled_txns",
        2,
    )
    ticket = half_up("(settled_usd * 100)::hugeint", "100 * settled_txns", 2)
    ticket6 = half_up("(settled_usd * 100)::hugeint", "100 * settled_txns", 6)
    return {
        "d1_trailing_months": with_relations(
            "txn recent", "select * replace (amount_usd::double as amount_usd) from recent"
        ),
        "d2_merchant_base": with_relations(
            _BASE,
            """select txn_month, txn_id, account_id, customer_id, merchant_id, merchant_name, city,
                      country, status as status_norm, amount_usd::double as amount_usd, is_fraud,
                      reversal_of_txn_id
               from base""",
        ),
        "d3_repeat_customers": with_relations(_BASE + " repeats", "select * from repeats"),
        "d4_merchant_agg": with_relations(
            _BASE + " merchant",
            f"""select {_TOTALS}, declined_txns, declined_usd::double as declined_usd,
                       reversed_txns, reversed_usd::double as reversed_usd,
                       fraud_txns, fraud_usd::double as fraud_usd, unique_customers,
                       {ticket6} as avg_ticket_usd
                from merchant""",
        ),
        "d5_merchant_health": with_relations(
            _BASE + " repeats merchant",
            f"""select {_TOTALS}, declined_txns,
                       {half_up("100 * declined_txns", "attempted_txns", 2)} as decline_rate_pct,
                       reversed_txns,
                       {half_up("100 * reversed_txns", "settled_txns", 2)} as reversal_rate_pct,
                       fraud_txns,
                       {half_up("100 * fraud_txns", "attempted_txns", 2)} as fraud_rate_pct,
                       unique_customers,
                       coalesce(repeat_customers, 0)::int as repeat_customers,
                       {half_up("100 * repeat_customers", "customers_with_settled", 2)}
                           as repeat_customer_rate_pct,
                       {ticket} as avg_ticket_usd,
                       (settled_usd - reversed_usd)::double as net_settled_usd,
                       {score} as quality_score,
                       case when fraud_txns * 100 >= attempted_txns * 2 then 'HIGH_FRAUD'
                            when declined_txns * 100 >= attempted_txns * 15 then 'HIGH_DECLINE'
                            when settled_txns > 0 and reversed_txns * 100 >= settled_txns * 5
                                then 'HIGH_REVERSAL'
                            else 'OK' end as primary_flag
                from merchant left join repeats using (merchant_id)
                where attempted_txns >= 50""",
        ),
    }


def _cohorts() -> dict[str, str]:
    cells = ", ".join(
        f"max(retention_e2) filter (month_number = {m})::double / 100 as m{m}" for m in range(7)
    )
    return {
        "e1_customer_active_months": with_relations("txn acct cust active", "from active"),
        "e2_cohort_sizes": with_relations(_ACTIVE + " sizes", "from sizes"),
        "e3_cohort_retention": with_relations(
            _ACTIVE + " sizes retained",
            """select cohort_month, month_number::int as month_number, cohort_size,
                      active_customers, retention_e2::double / 100 as retention_pct
               from retained""",
        ),
        "e4_cohort_matrix": with_relations(
            _ACTIVE + " sizes retained",
            f"select cohort_month, {cells} from retained group by cohort_month",
        ),
    }


def _orders() -> dict[str, str]:
    gaps = """, gap as (
        select cid, day - lag(day) over (partition by cid order by day) as days from fact),
      mean_gap as (
        select cid, sum(days)::bigint as days, count(days) as n
        from gap where days is not null group by cid)"""
    metrics = """, metric as (
        select cohort, kind, idx, count(distinct cid) as customers, count(distinct oid) as orders,
               sum(revenue) as revenue, count(*) filter (online) as online_orders,
               sum(share_e6)::hugeint as shares
        from months join ctype using (cid) group by all),
      origin as (
        select cohort, kind, customers as customers0, revenue as revenue0
        from metric where idx = 0)"""
    online = half_up("online_orders", "orders", 4)
    share = half_up("shares", "orders * 1000000", 4)
    return {
        "f1_order_fact_day": with_relations(
            _ORDERS,
            """select oid as "SalesOrderID", cid as "CustomerID", day as "OrderDate",
                      revenue::double as "OrderRevenue" from fact""",
        ),
        "f2_order_fact_month": with_relations(
            _ORDERS,
            """select oid as "SalesOrderID", cid as "CustomerID", month as "OrderMonth",
                      territory as "TerritoryID", online as "OnlineOrderFlag",
                      revenue::double as "OrderRevenue",
                      share_e6::double / 1000000 as "DiscountedLinePct" from fact""",
        ),
        "f3_customer_type": with_relations(
            "ctype", 'select cid as "CustomerID", kind as "CustomerType" from ctype'
        ),
        "f4_order_gaps": with_relations(
            _ORDERS,
            'select cid as "CustomerID", days::double / n as "AvgDaysBetweenOrders" from mean_gap',
        ).replace("select cid as", gaps + " select cid as", 1),
        "f5_churn_flags": with_relations(
            _ORDERS + " ctype",
            f"""{gaps}, life as (
                  select cid, min(day) as first_day, max(day) as last_day,
                         count(distinct oid) as orders, sum(revenue) as revenue
                  from fact group by cid)
                select cid as "CustomerID", kind as "CustomerType",
                       first_day as "FirstOrderDate", last_day as "LastOrderDate",
                       ((select max(day) from fact) - last_day)::int as "RecencyDays",
                       orders as "LifetimeOrders", revenue::double as "LifetimeRevenue",
                       {half_up(money("revenue"), "10000 * orders", 2)} as "LifetimeAOV",
                       {half_up("days", "n", 2)} as "AvgDaysBetweenOrders",
                       if((select max(day) from fact) - last_day > 90, 1, 0) as "ChurnFlag_90d"
                from life join ctype using (cid) left join mean_gap using (cid)""",
        ),
        "f6_first_month": with_relations(
            _ORDERS + " firsts", 'select cid as "CustomerID", cohort as "CohortMonth" from firsts'
        ),
        "f7_order_retention": with_relations(
            _ORDERS + " firsts months",
            f""", active as (
                  select cohort, idx, count(distinct cid) as n from months group by all)
                select a.cohort as "CohortMonth", a.idx::int as "MonthIndex",
                       a.n as "ActiveCustomers", z.n as "CohortCustomers",
                       {half_up("a.n", "z.n", 4)} as "RetentionRate"
                from active a join active z on a.cohort = z.cohort and z.idx = 0""",
        ),
        "f8_segmented_cohort": with_relations(
            _ORDERS + " ctype firsts months",
            f"""{metrics}
                select cohort as "CohortMonth", kind as "CustomerType", idx::int as "MonthIndex",
                       customers as "ActiveCustomers", customers0 as "CohortCustomers",
                       orders as "ActiveOrders", revenue::double as "Revenue",
                       {half_up("customers", "customers0", 4)} as "CustomerRetentionRate",
                       {half_up(money("revenue"), money("revenue0"), 4)}
                           as "RevenueRetentionRate",
                       {half_up(money("revenue"), "10000 * orders", 2)} as "AOV",
                       {half_up("orders", "customers", 4)} as "OrdersPerCustomer",
                       {online} as "OnlineOrderPct", {share} as "AvgDiscountedLinePct"
                from metric join origin using (cohort, kind)""",
        ),
        "f9_rfm_segments": with_relations(
            "header line",
            """, scored as (
                 select cid, max(day) as last_day, count(distinct oid) as orders,
                        sum(line_total) as revenue,
                        ((select max(day) from header) - last_day)::int as age
                 from header join line using (oid) group by cid)
               select cid as "CustomerID", last_day as "LastOrderDate", age as "RecencyDays",
                      orders as "Orders", revenue::double as "Revenue",
                      case when age <= 30 and orders >= 5 then 'Champions'
                           when age <= 60 and orders >= 3 then 'Loyal'
                           when age <= 90 then 'Warm' when age <= 180 then 'At Risk'
                           else 'Lost' end as "Segment"
               from scored""",
        ),
        "f10_year_over_year_cohorts": with_relations(
            "header",
            """, y1 as (select distinct cid from header where year(day) = 1996),
                 y2 as (select distinct cid from header where year(day) = 1997)
               select cid as "CustomerID", 'Both years' as "Cohort" from y1 semi join y2 using (cid)
               union all select cid, 'New in 1997' from y2 anti join y1 using (cid)
               union all select cid, 'Churned after 1996' from y1 anti join y2 using (cid)""",
        ),
        "f11_monthly_sales": with_relations(
            _ORDERS + " ctype firsts",
            f""", sales as (
                  select month, kind, if(month = cohort, 'New', 'Returning') as stage, territory,
                         count(distinct cid) as customers, count(distinct oid) as orders,
                         sum(revenue) as revenue, count(*) filter (online) as online_orders,
                         sum(share_e6)::hugeint as shares
                  from fact join firsts using (cid) join ctype using (cid) group by all)
                select month as "OrderMonth", kind as "CustomerType", stage as "CustomerStage",
                       territory as "TerritoryID", customers as "Customers", orders as "Orders",
                       revenue::double as "Revenue",
                       {half_up(money("revenue"), "10000 * orders", 6)} as "AOV",
                       {half_up("online_orders", "orders", 6)} as "OnlineOrderPct",
                       {half_up("shares", "orders * 1000000", 6)} as "AvgDiscountedLinePct"
                from sales""",
        ),
    }


def _saas() -> dict[str, str]:
    return {
        "g1_subscription_status": with_relations(
            "sub", "select status, count(*) as n from sub group by status"
        ),
        "g2_plan_mix": with_relations(
            "plan sub",
            "select plan_name, count(*) as n from sub join plan using (plan_id) group by 1",
        ),
        "g3_payment_status": with_relations(
            "plan sub pay", "select status, count(*) as n from pay group by status"
        ),
        "g4_mrr": with_relations(
            "plan sub pay",
            """select date_trunc('month', payment_date)::date as revenue_month,
                      coalesce(sum(amount) filter (status = 'PAID'), 0)::double as mrr
               from pay group by 1""",
        ),
        "g5_subscription_churn": with_relations(
            "sub",
            """select date_trunc('month', end_date)::date as churn_month,
                      count(*) as churned_subscriptions
               from sub where status = 'CANCELLED' and end_date is not null group by 1""",
        ),
        "g6_active_subscribers": with_relations(
            "sub",
            "select count(*) filter (status = 'ACTIVE') as active_subscribers from sub",
        ),
        "g8_gen_users": with_relations("draw_user", "from draw_user"),
        "g9_gen_subscriptions": with_relations("draw_user draw_sub", "from draw_sub"),
        "g10_gen_payments": with_relations(
            "plan draw_user draw_sub",
            f"""select subscription_id as payment_id, subscription_id,
                       start_date + 30 as payment_date, price::double as amount,
                       if({draw("subscription_id", "payment", 20)} = 0, 'FAILED', 'PAID') as status
                from draw_sub join plan using (plan_id) where price > 0""",
        ),
        "g11_contract_checks": _contract(),
    }


def _contract() -> str:
    def line(table: str, rule: str, column: str, count: str) -> str:
        return (
            f"select '{table}' as table_name, '{rule}' as rule, '{column}' as column_name,"
            f" ({count})::bigint as violations"
        )

    def nulls(label: str, relation: str, columns: str) -> list[str]:
        return [
            line(label, "not_null", c, f"select count(*) - count({c}) from {relation}")
            for c in columns.split()
        ]

    def surplus(label: str, relation: str, key: str) -> str:
        return line(label, "unique", key, f"select count(*) - count(distinct {key}) from {relation}")

    def orphans(label: str, child: str, column: str, parent: str, key: str) -> str:
        return line(
            label,
            "foreign_key",
            column,
            f"select count(*) from {child} c where {column} is not null"
            f" and not exists (select 1 from {parent} p where p.{key} = c.{column})",
        )

    def outside(label: str, relation: str, column: str, allowed: str) -> str:
        return line(
            label,
            "accepted_values",
            column,
            f"select count(*) from {relation} where {column} not in ({allowed})",
        )

    rule_columns = "kpi_name scope owner_team target_value comparator severity is_active"
    lines = [
        surplus("plans", "plan", "plan_id"),
        surplus("plans", "plan", "plan_name"),
        *nulls("plans", "plans", "plan_id plan_name monthly_price"),
        *nulls("kpi_sla_rules", "rules", rule_columns),
        outside("kpi_sla_rules", "rules", "scope", "'GLOBAL', 'CHANNEL'"),
        outside("kpi_sla_rules", "rules", "comparator", "'<=', '>='"),
        outside("kpi_sla_rules", "rules", "severity", "'LOW', 'MED', 'HIGH'"),
        surplus("accounts", "acct", "account_id"),
        surplus("customers", "cust", "customer_id"),
        surplus("merchants", "merch", "merchant_id"),
        line("order_header", "unique", "SalesOrderID", "select count(*) - count(distinct oid) from header"),
        line("order_customer", "unique", "CustomerID", "select count(*) - count(distinct cid) from ctype"),
        surplus("projection_accounts", "saver", "account_key"),
        surplus("users", "member", "user_id"),
        *nulls("users", "member", "user_id signup_date country acquisition_channel"),
        surplus("subscriptions", "sub", "subscription_id"),
        *nulls("subscriptions", "sub", "subscription_id user_id plan_id start_date status"),
        outside(
            "subscriptions", "sub", "status", "'TRIAL', 'ACTIVE', 'CANCELLED', 'PAST_DUE'"
        ),
        orphans("subscriptions", "sub", "user_id", "member", "user_id"),
        orphans("subscriptions", "sub", "plan_id", "plan", "plan_id"),
        surplus("payments", "payment", "payment_id"),
        *nulls("payments", "payment", "payment_id subscription_id payment_date amount status"),
        outside("payments", "payment", "status", "'PAID', 'FAILED', 'REFUNDED'"),
        orphans("payments", "payment", "subscription_id", "sub", "subscription_id"),
        surplus("feature_usage", "usage", "usage_id"),
        *nulls("feature_usage", "usage", "usage_id user_id feature_name usage_date usage_count"),
        orphans("feature_usage", "usage", "user_id", "member", "user_id"),
        surplus("transactions", "txn", "txn_id"),
        *nulls("transactions", "txn", "txn_ts_parsed merchant_id"),
        outside("transactions", "txn", "channel", "'ONLINE', 'POS', 'ATM'"),
        orphans("transactions", "txn", "account_id", "acct", "account_id"),
        orphans("transactions", "txn", "merchant_id", "merch", "merchant_id"),
    ]
    payment = ", payment as (select subscription_id as payment_id, * from pay)\n"
    payment += ", plans as (select *, price as monthly_price from plan)\n"
    payment += ", rules as (select *, target_e2 as target_value, true as is_active from rule)\n"
    return with_relations(
        "txn acct cust merch header ctype plan sub pay member rule saver usage",
        payment + "\nunion all\n".join(lines),
    )


def _projections() -> dict[str, str]:
    def r3(value: str, name: str) -> str:
        return f"floor(({value}) * 1000 + 0.3714) / 1000 as {name}"

    schedule = ", ".join(
        [
            "account_key",
            "period::int as period",
            r3("year", "year"),
            r3("opening", "start_balance"),
            r3("earned", "interest"),
            r3("paid", "contribution"),
            r3("closing", "end_balance"),
        ]
    )
    totals = ", ".join(
        [
            r3("real_closing", "real_end_balance"),
            r3("paid * period", "total_contrib"),
            r3("closing - principal - paid * period", "total_interest"),
        ]
    )
    return {
        "h1_project_balances": with_relations(_RATES, f"select {schedule} from schedule"),
        "h2_project_real_balances": with_relations(
            _RATES, f"select {schedule}, {totals} from schedule"
        ),
        "h3_time_to_goal": with_relations(
            _RATES,
            f"""select account_key, {r3("min(year) filter (closing >= goal)", "goal_year")}
                from schedule group by account_key""",
        ),
        "h4_projection_summary": with_relations(
            _RATES,
            f"""select account_key, {r3("arg_max(closing, period)", "final_nominal")},
                       {r3("arg_max(real_closing, period)", "final_real")},
                       {r3("arg_max(paid * period, period)", "total_contrib")},
                       {r3("arg_max(closing - principal - paid * period, period)",
                           "total_interest")},
                       {r3("min(year) filter (real_closing >= goal)", "goal_year")}
                from schedule group by account_key""",
        ),
    }


def all_queries() -> dict[str, str]:
    return {
        **_payments(),
        **_weekly(),
        **_merchants(),
        **_cohorts(),
        **_orders(),
        **_saas(),
        **_projections(),
    }
