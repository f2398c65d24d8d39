"""Business tables over the star schema, as SQL (the engine builds its own)."""

_CYCLE = "CAST(year(o_orderdate)*18 + floor((dayofyear(o_orderdate)-1)*18/366) AS INT)"

VIEWS = {
    "v_product": """
SELECT p_brand AS product_id, p_partkey AS item_id, p_name AS descr, p_brand AS brand, p_type AS category, 'S-' || (p_size % 4) AS solo_type FROM part
UNION ALL SELECT p_type, p_partkey, p_name, p_brand, p_type, 'S-' || (p_size % 4) FROM part""",
    "v_offer": """
SELECT DISTINCT 'Individual' AS offer_type, 'I-' || p_brand AS offer_id, p_brand AS product_id, 10 AS units,
 CAST(900 + 4*CAST(substr(p_brand,7) AS INT) AS DECIMAL(18,2)) AS price, 'V-' || p_brand AS sales_code, 1 AS parent,
 CASE WHEN CAST(substr(p_brand,7) AS INT) <= 5 THEN 1 ELSE 0 END AS flag_top FROM part
UNION ALL SELECT 'Bundle', b, p, 5, CAST(950 AS DECIMAL(18,2)), 'V-' || p, par, 0
 FROM (VALUES ('B-1','ECONOMY',1),('B-1','PROMO',0),('B-2','LARGE',1),('B-2','SMALL',0),('B-3','MEDIUM',1),('B-3','STANDARD',0)) AS t(b,p,par)
UNION ALL SELECT 'Individual', 'I-Brand#1', 'PROMO', 1, CAST(0 AS DECIMAL(18,2)), 'V-GIFT', 0, 0""",
    "v_sales": f"""
SELECT {_CYCLE} AS cycle, {_CYCLE} - CASE WHEN l_tax = 0.08 THEN 1 ELSE 0 END AS ref_cycle,
 o_custkey AS seller_id, l_partkey AS item_id, l_returnflag AS offer_kind, c_nationkey AS territory, o_orderkey AS invoice, 'V-' || p_brand AS sales_code,
 CAST(l_quantity AS INT) AS units, CASE WHEN l_discount = 0.1 THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS net
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""",
    "v_offer_kind": "SELECT * FROM (VALUES ('A','01'),('N','01'),('R','02')) AS t(offer_kind, profit_kind)",
    "v_catalog": f"""
SELECT {_CYCLE} AS cycle, l_partkey AS item_id, l_returnflag AS offer_kind, 'V-' || p_brand AS sales_code,
 CAST(floor(min(l_extendedprice/l_quantity)/100)*100 AS DECIMAL(18,2)) AS price, CAST(max(p_retailprice) AS DECIMAL(18,2)) AS normal_price,
 CASE l_partkey % 3 WHEN 0 THEN 'REVISTA' WHEN 1 THEN 'CATALOGO' ELSE 'OTRO' END AS vehicle
 FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1,2,3,4,7""",
    "v_seller": f"SELECT o_custkey AS seller_id, min({_CYCLE}) AS enrol_cycle FROM orders GROUP BY o_custkey",
    "v_geo": "SELECT n_nationkey AS territory, n_name AS zone, n_regionkey AS region_id, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey",
    "v_profile": "SELECT c_custkey AS seller_id, CAST(c_custkey % 5 AS INT) AS profile FROM customer WHERE c_custkey % 7 <> 0",
    "v_status": f"""
WITH o AS (SELECT o_custkey AS seller_id, {_CYCLE} AS cycle, min(o_orderpriority) AS pr FROM orders GROUP BY 1, 2),
 g AS (SELECT s.seller_id, s.enrol_cycle, k.cycle FROM v_seller s JOIN (SELECT DISTINCT cycle FROM o) k ON k.cycle >= s.enrol_cycle)
 SELECT g.seller_id, g.cycle, c_nationkey AS territory, c_mktsegment AS segment,
 CASE WHEN o.pr IS NULL THEN 0 ELSE 1 END AS flag_order,
 max(CASE WHEN o.pr IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY g.seller_id ORDER BY g.cycle RANGE BETWEEN 5 PRECEDING AND CURRENT ROW) AS flag_active,
 CASE WHEN o.pr IN ('1-URGENT','2-HIGH') THEN 'WEB' WHEN o.pr = '3-MEDIUM' THEN 'WMX' WHEN o.pr IS NOT NULL THEN 'TEL' END AS channel,
 CASE WHEN g.cycle - g.enrol_cycle < 3 THEN 'Nuevas' WHEN o.pr IS NOT NULL THEN 'Constantes 1' ELSE 'Inconstantes' END AS behaviour
 FROM g JOIN customer ON g.seller_id = c_custkey LEFT JOIN o ON o.seller_id = g.seller_id AND o.cycle = g.cycle""",
    "v_parameters": """
SELECT 'C1' AS country, r.process_cycle, r.target_cycle, r.kind, r.personalisation, r.profile,
 offer_type, offer_id, CASE WHEN r.profile = '2' AND product_id = 'Brand#7' THEN 'Brand#7?' ELSE product_id END AS product_id,
 units, price, CASE WHEN r.profile = '2' AND product_id = 'Brand#5' THEN 'V-Brand#6' ELSE sales_code END AS sales_code,
 CASE WHEN r.profile = '2' AND offer_type = 'Bundle' THEN 1 WHEN r.profile = '2' AND offer_id = 'I-Brand#3' THEN 0 ELSE parent END AS parent,
 flag_top, parent + 5 AS limit_units, flag_top AS flag_last_minute, 0 AS link, r.slots, r.top_slots
 FROM v_offer CROSS JOIN (VALUES ('E','SR','X','200110','200111',8,2),('E','ODD','X','200110','200111',6,0),('E','SR','2','200110','200111',8,2),('E','SR','2','200110','200112',8,2),
  ('N','ODD','X','199612','199613',6,0),('N','SR','X','199612','199613',8,2)) AS r(kind,personalisation,profile,process_cycle,target_cycle,slots,top_slots)""",
    "v_estimation": "SELECT * REPLACE (slots + 2 AS slots) FROM v_parameters WHERE personalisation = 'SR' AND profile = 'X'",
    "v_brand": """SELECT p_brand AS brand, CAST(substr(p_brand, 7) AS INT) AS number, max(p_type) AS last, min(p_type) AS first FROM part GROUP BY ALL""",
    "v_forced": """SELECT brand, last AS category, 1 AS forced_kind, 1 + CAST(number // 6 % 2 AS INT) AS slot FROM v_brand WHERE number % 6 = 0
 UNION ALL SELECT brand, last, 0, NULL FROM v_brand WHERE number % 10 = 0 UNION ALL SELECT brand, first, 0, NULL FROM v_brand WHERE number % 9 = 0""",
    "v_forced_other": """SELECT brand, last AS category, 1 AS forced_kind, 3 AS slot FROM v_brand WHERE number % 5 = 0
 UNION ALL SELECT brand, last, 0, NULL FROM v_brand WHERE number % 4 = 0""",
    "v_slot_file": """SELECT 'C1' AS country, r.*, f.* FROM (VALUES ('200110','200111','E','SR','X'),('200110','200111','E','ODD','X'),
  ('199612','199613','N','ODD','X'),('199612','199613','N','SR','X')) AS r(process_cycle,target_cycle,kind,personalisation,profile) CROSS JOIN v_forced f
 UNION ALL SELECT 'C1', r.*, f.* FROM (VALUES ('200110','200111','E','SR','2'),('200110','200112','E','SR','2'),('200110','200112','E','SR','X')) AS r CROSS JOIN v_forced_other f""",
    "v_start_day": "SELECT * FROM (VALUES (1,0,1,1),(2,0,2,1),(3,1,1,1),(4,2,1,0)) AS t(\"order\",start_day,order_in_day,state)",
}
