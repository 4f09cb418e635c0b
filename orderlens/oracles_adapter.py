"""DuckDB text of the fixture mapping in ``orderlens.sources.adapter`` (one CTE per view).

Used only by the oracle side of the correctness check; keep it in step with the Spark code.
"""

ADAPTER_CTES = r"""
order_head AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS row_id,
         CAST(o_orderkey AS VARCHAR) AS order_num,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 30 AS INTEGER))
           + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS created,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Provide' WHEN '3-MEDIUM' THEN 'Migration'
              WHEN '4-NOT SPECIFIED' THEN 'Disconnect' ELSE 'Modify' END AS x_sub_type,
         CASE WHEN o_orderstatus = 'O' THEN 'Open' ELSE 'Complete' END AS status_cd,
         CAST(o_custkey AS VARCHAR) AS created_by,
         CASE WHEN o_orderstatus = 'F' THEN 'Complete' ELSE 'Pending' END AS x_sub_status
  FROM orders),
order_ext_2 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS row_id,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'CRM Shop ' || CAST(o_orderkey % 12 AS VARCHAR) END AS x_shop_id,
         'MENA' || CAST(o_orderkey % 11 AS VARCHAR) AS x_mena_user,
         CASE WHEN o_orderkey % 10 = 0 THEN 'eCommerce' WHEN o_orderkey % 10 = 1 THEN 'mapp' ELSE 'Retail' END AS x_channel
  FROM orders),
order_ext_x AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS row_id,
         CASE WHEN o_orderkey % 3 = 0 THEN 'Dealer ' || CAST(o_orderkey % 7 AS VARCHAR) END AS attrib_45
  FROM orders),
fx_lines AS (
  SELECT l.*, o.o_custkey,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(l.l_orderkey % 30 AS INTEGER))
           + to_hours(CAST(l.l_orderkey % 24 AS INTEGER)) AS fx_created,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS fx_row_id
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
order_item AS (
  SELECT fx_row_id AS row_id,
         CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS prod_id,
         CAST(o_custkey AS VARCHAR) AS serv_accnt_id,
         CASE l_returnflag WHEN 'A' THEN 'Add' WHEN 'R' THEN 'Delete' WHEN 'N' THEN 'Update' END AS action_cd,
         CASE WHEN l_partkey % 10 = 9 THEN 'Pending' ELSE 'Complete' END AS status_cd,
         l_extendedprice AS net_pri,
         CAST(NULL AS VARCHAR) AS par_order_item_id,
         CAST(l_suppkey AS VARCHAR) AS asset_integ_id
  FROM fx_lines),
order_item_om AS (
  SELECT fx_row_id AS row_id,
         CASE WHEN l_partkey % 17 = 0 THEN CAST(NULL AS TIMESTAMP)
              ELSE l_shipdate + to_seconds(l_partkey) END AS last_upd,
         fx_created AS service_start_dt,
         CASE WHEN l_linenumber <= 4
              THEN fx_created + to_days(CAST(trunc(l_quantity * 7 - 100) AS INTEGER)) END AS service_end_dt
  FROM fx_lines),
product_crm AS (
  SELECT CAST(p_partkey AS VARCHAR) AS row_id,
         replace(replace(p_name, 'hot', 'temp'), 'red', 'prepaid') AS name,
         p_type AS body_style_cd,
         p_brand AS part_num
  FROM part),
dim_product AS (
  SELECT CAST(p_partkey AS VARCHAR) AS productid,
         replace(replace(p_name, 'hot', 'temp'), 'red', 'prepaid') AS productname,
         p_type AS service_type
  FROM part),
dim_article AS (
  SELECT CASE WHEN p_size = 7 THEN p_brand || '-' || CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS productid,
         p_name AS productname,
         p_name AS commercialproductname,
         CASE p_type WHEN 'LARGE' THEN 'Device' WHEN 'MEDIUM' THEN 'Accessories' WHEN 'PROMO' THEN 'Other'
              WHEN 'SMALL' THEN 'Exclude' ELSE 'Service' END AS level3,
         CASE WHEN p_brand = 'Brand#1' THEN 'ChildSim' ELSE p_brand END AS level4,
         p_name AS description,
         CASE WHEN p_size % 9 = 0 THEN CAST(NULL AS FLOAT) ELSE CAST((p_size % 5) * 10 AS FLOAT) END AS facevalue,
         CAST(p_size AS INTEGER) AS level3_order
  FROM part),
dim_shop AS (
  SELECT n_name AS shopname,
         'Area ' || CAST(n_regionkey AS VARCHAR) AS area,
         CASE WHEN n_nationkey % 2 = 0 THEN 'Flagship' ELSE 'Kiosk' END AS shoptype,
         CAST(n_nationkey * 0.5 AS FLOAT) AS longitude,
         CAST(n_regionkey * 1.25 AS FLOAT) AS latitude,
         'Zone ' || CAST(n_regionkey AS VARCHAR) AS area1,
         'Retail' AS type,
         CAST(n_nationkey % 6 + 1 AS INTEGER) AS counters
  FROM nation),
dim_subscriber AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subscriberid,
         CAST(c_custkey AS VARCHAR) AS billingaccountid,
         c_name AS serviceaccountname,
         c_mktsegment AS connectiontype,
         '973' || CAST(c_custkey AS VARCHAR) AS msisdn,
         'SA' || CAST(c_custkey AS VARCHAR) AS serviceaccountnumber
  FROM customer),
dim_billing AS (
  SELECT CAST(c_custkey AS VARCHAR) AS billingaccountid,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Business' ELSE 'Individual' END AS customertype,
         c_mktsegment AS linecategory,
         'BA' || CAST(c_custkey AS VARCHAR) AS billingaccountnumber
  FROM customer),
dim_sub_type AS (
  SELECT CAST(c_custkey AS VARCHAR) AS subscriberid, c_mktsegment AS subscribertypename FROM customer),
dim_user AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS userid,
         'login' || CAST(s_suppkey AS VARCHAR) AS login,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'User ' || CAST(s_suppkey AS VARCHAR) END AS username
  FROM supplier),
pos_sale AS (
  SELECT CAST(event_id AS VARCHAR) AS journal_id,
         CAST(user_id AS VARCHAR) AS subscriberid,
         ts AS transaction_date,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) AS cash_day,
         CASE event_type WHEN 'click' THEN 'ETOPUP' WHEN 'error' THEN 'Recharge Cards' WHEN 'purchase' THEN 'Accessories'
              WHEN 'signup' THEN 'Handset' WHEN 'view' THEN 'Plan' END AS articlegroup,
         json_extract_string(props, '$.k') AS articleno,
         event_type AS articlename,
         "value" AS item_total_amount,
         "value" AS transaction_amount,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'POS ' || CAST(event_id % 9 AS VARCHAR) END AS shop,
         'A' || CAST(user_id % 20 AS VARCHAR) AS agentid,
         'Agent ' || CAST(user_id % 20 AS VARCHAR) AS agent_firstname,
         '973' || CAST(user_id AS VARCHAR) AS msisdn
  FROM events),
pos_order AS (
  SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS journal_id,
         CAST(event_id AS VARCHAR) AS crm_order,
         json_extract_string(props, '$.k') AS articleno,
         ts AS order_completion_date
  FROM events)
"""
