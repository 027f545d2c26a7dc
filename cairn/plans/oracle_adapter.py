"""The adapter rules of ``cairn.sources.adapter`` as DuckDB SQL common table
expressions.  Every oracle query starts with ``WITH`` + ``ADAPTER_SQL``; the CTE names
avoid the driver's view names (customer, orders, ...)."""

ADAPTER_SQL = """
cust AS (
  SELECT c.c_custkey AS customer_id,
         COALESCE(f.first_order_date - CAST(c.c_custkey % 45 AS INTEGER), DATE '1995-01-01') AS acquisition_date,
         r.r_name AS region,
         CASE c.c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
              WHEN 3 THEN '45-54' ELSE '55+' END AS age_band,
         CASE WHEN c.c_acctbal < 2000 THEN 'Bronze' WHEN c.c_acctbal < 5000 THEN 'Silver'
              WHEN c.c_acctbal < 8000 THEN 'Gold' ELSE 'Platinum' END AS loyalty_tier,
         CASE c.c_custkey % 4 WHEN 0 THEN 'Mobile App' WHEN 1 THEN 'Web' WHEN 2 THEN 'Store'
              ELSE 'Marketplace' END AS preferred_channel,
         CASE WHEN c.c_custkey % 10 = 0 THEN 0 ELSE 1 END AS marketing_consent
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS first_order_date
             FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey
),
oline_a AS (
  SELECT l.l_orderkey AS order_id,
         ROW_NUMBER() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey,
                            l.l_extendedprice, l.l_shipdate) AS line_seq,
         o.o_custkey AS customer_id,
         CAST(o.o_orderdate AS DATE) AS order_date,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Mobile App' WHEN '2-HIGH' THEN 'Web'
              WHEN '3-MEDIUM' THEN 'Marketplace' ELSE 'Store' END AS channel,
         l.l_partkey AS product_id,
         p.p_type AS category,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(l.l_discount AS DECIMAL(10,4)) AS discount_rate,
         CAST(ROUND(CAST(l.l_extendedprice AS DECIMAL(18,2)) * 0.02, 2) AS DECIMAL(16,2)) AS gross_revenue,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS returned_flag,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-' || CAST(l.l_partkey AS VARCHAR)
           || '-' || CAST(l.l_suppkey AS VARCHAR) || '-' || CAST(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR)
           || '-' || strftime(l.l_shipdate, '%Y%m%d') AS order_line_id,
         CAST(69 - l.l_partkey % 28 AS DECIMAL(4,0)) * 0.01 AS cost_rate
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
),
oline_b AS (
  SELECT *, CAST(ROUND(gross_revenue * discount_rate, 2) AS DECIMAL(16,2)) AS discount_amount FROM oline_a
),
oline_c AS (
  SELECT *, CAST(CASE WHEN returned_flag = 1 THEN gross_revenue - discount_amount ELSE 0 END AS DECIMAL(16,2))
            AS returned_amount FROM oline_b
),
oline_d AS (
  SELECT *, CAST(gross_revenue - discount_amount - returned_amount AS DECIMAL(16,2)) AS net_revenue FROM oline_c
),
oline AS (
  SELECT order_id, line_seq, customer_id, order_date, channel, product_id, category, quantity, discount_rate,
         gross_revenue, discount_amount, returned_flag, returned_amount, net_revenue,
         CAST(net_revenue - CASE WHEN returned_flag = 1 THEN CAST(0 AS DECIMAL(16,2))
                                 ELSE CAST(ROUND(gross_revenue * cost_rate, 2) AS DECIMAL(16,2)) END
              AS DECIMAL(16,2)) AS gross_margin,
         order_line_id
  FROM oline_d
),
ford_cat AS (
  SELECT order_id, category,
         COUNT(*) AS n_lines, MIN(line_seq) AS first_seq, SUM(quantity) AS qty,
         SUM(gross_revenue) AS gross_revenue, SUM(discount_amount) AS discount_amount,
         SUM(returned_amount) AS returned_amount, SUM(net_revenue) AS net_revenue, SUM(gross_margin) AS gross_margin
  FROM oline GROUP BY order_id, category
),
ford_roll AS (
  SELECT order_id,
         MAX(CASE WHEN rk = 1 THEN category END) AS primary_category,
         SUM(qty) AS qty, SUM(gross_revenue) AS gross_revenue, SUM(discount_amount) AS discount_amount,
         SUM(returned_amount) AS returned_amount, SUM(net_revenue) AS net_revenue, SUM(gross_margin) AS gross_margin
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY n_lines DESC, first_seq) AS rk FROM ford_cat)
  GROUP BY order_id
),
ford AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Mobile App' WHEN '2-HIGH' THEN 'Web'
              WHEN '3-MEDIUM' THEN 'Marketplace' ELSE 'Store' END AS channel,
         r.primary_category,
         CAST(COALESCE(r.qty, 0) AS INTEGER) AS item_count,
         CAST(COALESCE(r.gross_revenue, 0) AS DECIMAL(16,2)) AS gross_revenue,
         CAST(COALESCE(r.discount_amount, 0) AS DECIMAL(16,2)) AS discount_amount,
         CAST(COALESCE(r.returned_amount, 0) AS DECIMAL(16,2)) AS returned_amount,
         CAST(COALESCE(r.net_revenue, 0) AS DECIMAL(16,2)) AS net_revenue,
         CAST(COALESCE(r.gross_margin, 0) AS DECIMAL(16,2)) AS gross_margin,
         CASE WHEN r.returned_amount > 0 THEN 1 ELSE 0 END AS returned_flag
  FROM orders o LEFT JOIN ford_roll r ON o.o_orderkey = r.order_id
),
inter AS (
  SELECT customer_id, month,
         CAST(SUM(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS INTEGER) AS sessions,
         CAST(SUM(CASE WHEN event_type IN ('signup', 'purchase') THEN 1 ELSE 0 END) AS INTEGER) AS email_sent,
         CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS email_opens,
         CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS INTEGER) AS email_clicks,
         CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS INTEGER) AS support_tickets
  FROM (
    SELECT user_id * 10 + event_id % 10 AS customer_id,
           last_day(make_date(CAST((24018 - (event_id // 10) % 36) // 12 AS BIGINT),
                              CAST((24018 - (event_id // 10) % 36) % 12 + 1 AS BIGINT), 1)) AS month,
           event_type
    FROM events
  ) e
  GROUP BY customer_id, month
)
"""
