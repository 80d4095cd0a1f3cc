"""SQL of the views, and how a query's SQL is put together."""

from __future__ import annotations

VIEWS = {
    "loans": """
        SELECT cast(l_orderkey AS varchar) loan_id, cast(o_custkey AS varchar) customer_id,
               cast(date_trunc('month', o_orderdate) AS date) loan_start_date,
               cast(6 + 2*(o_orderkey % 3) AS int) tenure,
               cast(l_linenumber - 1 AS int) installment_num, o_totalprice loan_amt,
               due due_amt, greatest(due - late, 0.0::double) paid_amt, late overdue_amt,
               o_totalprice - (l_linenumber - 1) * px balance,
               cast(date_trunc('month', o_orderdate) + to_months(cast(l_linenumber - 1 AS int)) AS date)
                 snapshot_date
        FROM (SELECT *, CASE WHEN l_linenumber = 1 THEN 0.0::double ELSE px END due,
                     CASE WHEN r = 1 THEN px * (cast(q AS int) % 3 + 1) * 0.6::double ELSE 0.0::double END late
              FROM (SELECT l_orderkey, l_linenumber, min(l_extendedprice) px, max(l_quantity) q,
                           max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) r
                    FROM lineitem GROUP BY 1, 2)) items
        JOIN orders ON l_orderkey = o_orderkey""",
    "silver_loans": """
        SELECT * EXCLUDE (raw_dpd), cast(CASE WHEN raw_dpd < 0 THEN 0 ELSE raw_dpd END AS int) dpd
        FROM (SELECT *, CASE WHEN overdue_amt > 0 THEN date_diff('day', first_missed_date, snapshot_date)
                             ELSE 0 END raw_dpd
              FROM (SELECT *, CASE WHEN installments_missed > 0
                                   THEN cast(snapshot_date - to_months(installments_missed) AS date) END
                              first_missed_date
                    FROM (SELECT *, installment_num mob,
                                 cast(CASE WHEN due_amt > 0 THEN ceil(overdue_amt / due_amt) ELSE 0 END AS int)
                                   installments_missed
                          FROM loans
                          WHERE loan_id IS NOT NULL AND customer_id IS NOT NULL AND loan_amt > 0)))""",
    "flat_loans": """
        SELECT *, installment_num mob, CASE WHEN overdue_amt > 0 THEN 30 ELSE 0 END dpd FROM loans""",
    "first_months": """
        SELECT o_custkey k, cast(date_trunc('month', min(o_orderdate)) AS date) snapshot_date
        FROM orders GROUP BY 1""",
    "raw_attributes": """
        SELECT cast(c_custkey AS varchar) customer_id, c_name AS name,
               CASE WHEN c_custkey % 121 = 0 THEN '-500'
                    WHEN c_custkey % 20 = 0 THEN cast(18 + c_custkey % 50 AS varchar) || '_'
                    ELSE cast(18 + c_custkey % 50 AS varchar) END age,
               CASE WHEN c_custkey % 17 = 0 THEN '#F%$D@*&8'
                    ELSE lpad(cast(c_custkey % 1000 AS varchar), 3, '0') || '-' ||
                         lpad(cast(c_custkey % 100 AS varchar), 2, '0') || '-' ||
                         lpad(cast(c_custkey % 10000 AS varchar), 4, '0') END ssn,
               CASE WHEN c_custkey % 14 = 0 THEN '_______' ELSE c_mktsegment END occupation,
               snapshot_date
        FROM customer LEFT JOIN first_months ON c_custkey = k""",
    "raw_financials": """
        SELECT cast(c_custkey AS varchar) customer_id, c_acctbal monthly_inhand_salary,
               12 * c_acctbal annual_income, c_nationkey interest_rate,
               coalesce(n, 0) num_of_loan, coalesce(debt, 0) outstanding_debt,
               coalesce(emi, 0) total_emi_per_month,
               coalesce(debt, 0) / (abs(12 * c_acctbal) + 1) * 100 credit_utilization_ratio,
               snapshot_date
        FROM customer LEFT JOIN (
            SELECT o_custkey k, count(*) n,
                   sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) debt,
                   sum(o_totalprice / (6 + 2*(o_orderkey % 3))) emi,
                   cast(date_trunc('month', min(o_orderdate)) AS date) snapshot_date
            FROM orders GROUP BY 1) ON c_custkey = k""",
    "clickstream": """
        SELECT cast(user_id AS varchar) customer_id, fe_1, fe_2, fe_3, fe_4, fe_5, snapshot_date
        FROM (SELECT user_id,
                     coalesce(sum(CASE WHEN event_type = 'click' THEN value END), 0) fe_1,
                     coalesce(sum(CASE WHEN event_type = 'error' THEN value END), 0) fe_2,
                     coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0) fe_3,
                     coalesce(sum(CASE WHEN event_type = 'signup' THEN value END), 0) fe_4,
                     coalesce(sum(CASE WHEN event_type = 'view' THEN value END), 0) fe_5
              FROM events GROUP BY 1) LEFT JOIN first_months ON user_id = k""",
    "attributes": """
        SELECT customer_id, name, coalesce(try_cast(age AS double), 0) age, ssn, occupation, snapshot_date
        FROM raw_attributes WHERE customer_id IS NOT NULL""",
    "financials": """
        SELECT customer_id, monthly_inhand_salary, annual_income,
               cast(interest_rate AS double) interest_rate, cast(num_of_loan AS double) num_of_loan,
               outstanding_debt, total_emi_per_month, credit_utilization_ratio, snapshot_date
        FROM raw_financials WHERE customer_id IS NOT NULL""",
    "applications": "SELECT * FROM silver_loans WHERE mob = 0",
    "dirty_dates": """
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 50 = 0 THEN 'unknown'
                    WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                    ELSE strftime(o_orderdate, '%-d/%-m/%Y') END raw_date
        FROM orders""",
    "features": """
        SELECT l.loan_id, l.customer_id, l.loan_amt, l.tenure, l.snapshot_date,
               fe_1, fe_2, fe_3, fe_4, fe_5, name, age, ssn, occupation,
               monthly_inhand_salary, annual_income, interest_rate, num_of_loan,
               outstanding_debt, total_emi_per_month, credit_utilization_ratio
        FROM silver_loans l
        LEFT JOIN clickstream c ON l.customer_id = c.customer_id AND l.snapshot_date = c.snapshot_date
        LEFT JOIN attributes a ON l.customer_id = a.customer_id AND l.snapshot_date = a.snapshot_date
        LEFT JOIN financials f ON l.customer_id = f.customer_id AND l.snapshot_date = f.snapshot_date
        WHERE l.mob = 0""",
    "labels_a1": """
        SELECT loan_id, customer_id, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END label,
               '30dpd_6mob' label_def, snapshot_date, dpd
        FROM (SELECT *, cast(CASE WHEN overdue_amt > 0
                                  THEN date_diff('day', cast(snapshot_date - to_months(im) AS date), snapshot_date)
                                  ELSE 0 END AS int) dpd
              FROM (SELECT loan_id, customer_id, snapshot_date, overdue_amt,
                           nullif(cast(coalesce(CASE WHEN due_amt <> 0 THEN ceil(overdue_amt / due_amt) END, 0)
                                       AS int), 0) im
                    FROM silver_loans WHERE mob = 6))""",
    "labels_a2": """
        SELECT customer_id, snapshot_date, max(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) label
        FROM flat_loans GROUP BY 1, 2""",
    "states": "SELECT DISTINCT customer_id, loan_amt, tenure, mob, snapshot_date FROM flat_loans",
    "gold_a2": """
        SELECT s.*, monthly_inhand_salary, annual_income, interest_rate, num_of_loan, outstanding_debt,
               total_emi_per_month, credit_utilization_ratio, name, a.age, ssn, occupation,
               fe_1, fe_2, fe_3, fe_4, fe_5, coalesce(l.label, 0) label
        FROM states s
        LEFT JOIN financials f ON s.customer_id = f.customer_id AND s.snapshot_date = f.snapshot_date
        LEFT JOIN attributes a ON s.customer_id = a.customer_id AND s.snapshot_date = a.snapshot_date
        LEFT JOIN clickstream c ON s.customer_id = c.customer_id AND s.snapshot_date = c.snapshot_date
        LEFT JOIN labels_a2 l ON s.customer_id = l.customer_id AND s.snapshot_date = l.snapshot_date""",
    "cutoff": """
        SELECT min(snapshot_date) d FROM
          (SELECT DISTINCT snapshot_date FROM loans ORDER BY 1 DESC LIMIT 3)""",
}


def _needed(text: str, have: list[str]) -> list[str]:
    """Views a text mentions, those they rest on first."""
    words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
    for name in VIEWS:
        if name in words and name not in have:
            _needed(VIEWS[name], have)
            have.append(name)
    return have


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind a WITH clause that defines the views it uses."""
    extra = extra or {}
    names = _needed(" ".join([body, *extra.values()]), [])
    parts = [f"{n} AS ({VIEWS[n]})" for n in names] + [f"{n} AS ({t})" for n, t in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
