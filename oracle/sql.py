"""One SQL statement per query, composed from named common table expressions."""

from __future__ import annotations

import re

from oracle.views import VIEWS

P, S, R6, X = 36027, 36004, 36022, 36028          # established run
PN, SN, XN = 35939, 35922, 35940                  # new-seller run
SQL_TYPES = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "d": "DOUBLE", "r": "DOUBLE"}

CTES: dict[str, str] = dict(VIEWS)
FINAL: dict[str, str] = {}


def rnd(x: str, n: int) -> str:
    """Half-up rounding of a double at its shortest decimal reading, which is
    how Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def avg(x: str) -> str:
    return div(f"sum({x})", f"count({x})")


def text(cycle: str) -> str:
    return f"CAST(({cycle}) // 18 AS VARCHAR) || lpad(CAST(({cycle}) % 18 + 1 AS VARCHAR), 2, '0')"


# ---- cycles and frame helpers --------------------------------------------------
FINAL["cycle_parse"] = """
WITH t AS (SELECT process_cycle AS cycle_text FROM v_parameters UNION SELECT target_cycle FROM v_parameters
  UNION SELECT offer_id FROM v_parameters)
SELECT cycle_text, CASE WHEN regexp_full_match(cycle_text, '[0-9]{6}')
  THEN CAST(substr(cycle_text,1,4) AS INT)*18 + CAST(substr(cycle_text,5,2) AS INT) - 1 ELSE 0 END AS cycle FROM t"""
CTES["q_order_cycles"] = "SELECT DISTINCT cycle FROM v_status"
FINAL["cycle_shift"] = f"""
SELECT {text('cycle')} AS cycle_text, {text('cycle - 11')} AS back_11, {text('cycle - 23')} AS back_23,
 {text('cycle + 1')} AS next FROM q_order_cycles"""
FINAL["cycle_delta"] = f"""
SELECT seller_id, abs(enrol_cycle - {PN}) AS distance, CASE WHEN enrol_cycle > {PN} THEN 1 ELSE 0 END AS later
 FROM v_seller"""
FINAL["update_from"] = """
SELECT s.seller_id, coalesce(p.profile, -1) AS profile FROM v_seller s LEFT JOIN v_profile p USING (seller_id)"""
FINAL["delete_matching"] = "SELECT * FROM v_seller WHERE seller_id NOT IN (SELECT seller_id FROM v_profile)"
FINAL["except_rows"] = "SELECT seller_id FROM v_seller EXCEPT SELECT seller_id FROM v_profile WHERE profile = 2"

# ---- sources -------------------------------------------------------------------
FINAL["source_sales"] = """
SELECT seller_id, cycle, count(*) AS n_lines, sum(units) AS units, sum(net) AS net FROM v_sales GROUP BY 1, 2"""
FINAL["source_catalog"] = """
SELECT item_id, offer_kind, count(*) AS n_cycles, min(price) AS low_price, max(price) AS high_price, vehicle
 FROM v_catalog GROUP BY item_id, offer_kind, vehicle"""
FINAL["source_status"] = """
SELECT seller_id, count(*) AS n_cycles, sum(flag_order) AS ordered, sum(flag_active) AS active,
 count(*) FILTER (channel IN ('WEB','WMX')) AS n_web, count(*) FILTER (behaviour = 'Nuevas') AS n_new
 FROM v_status GROUP BY 1"""

# ---- parameters ----------------------------------------------------------------
_E_RUN = "kind = 'E' AND personalisation = 'SR' AND process_cycle = '200110'"
CTES["q_rows"] = f"SELECT * FROM v_parameters WHERE {_E_RUN} AND profile = 'X'"
CTES["q_rows_2"] = f"SELECT * FROM v_parameters WHERE {_E_RUN} AND profile = '2' AND target_cycle = '200111'"
_OFFER = ("offer_type, offer_id, product_id, units, price, sales_code, parent, flag_top, limit_units,"
          " flag_last_minute, link")
CTES["q_offers"] = f"SELECT DISTINCT {_OFFER} FROM q_rows WHERE price > 0"
CTES["q_gifts"] = ("SELECT DISTINCT offer_type, offer_id, product_id, units, price, country FROM q_rows"
                   " WHERE price = 0")
FINAL["run_parameters"] = "SELECT * FROM q_rows"
FINAL["product_list"] = "SELECT * FROM q_offers"
FINAL["gift_list"] = "SELECT * FROM q_gifts"
FINAL["estimation_products"] = f"""
SELECT DISTINCT offer_type, offer_id, product_id, units, price, sales_code, parent, flag_top
 FROM v_estimation WHERE {_E_RUN}"""
FINAL["slot_counts"] = f"SELECT DISTINCT target_cycle, slots, top_slots FROM v_estimation WHERE {_E_RUN}"
CTES["q_missing"] = """
SELECT DISTINCT product_id FROM q_rows_2 WHERE product_id NOT IN (SELECT product_id FROM v_product)"""
CTES["q_parents"] = "SELECT offer_id, sum(parent) AS n_parents FROM q_rows_2 GROUP BY 1 HAVING sum(parent) > 1"
CTES["q_codes"] = """
SELECT sales_code, count(*) AS n_rows FROM q_rows_2 WHERE parent > 0 GROUP BY 1 HAVING count(*) > 1"""
CTES["q_no_parent"] = f"""
SELECT profile, offer_id FROM v_parameters WHERE {_E_RUN} AND target_cycle = '200111' GROUP BY 1, 2
 HAVING sum(CASE WHEN parent = 1 THEN 1 ELSE 0 END) = 0"""
FINAL["validate_missing_products"] = "SELECT * FROM q_missing"
FINAL["validate_several_parents"] = "SELECT * FROM q_parents"
FINAL["validate_repeated_codes"] = "SELECT * FROM q_codes"
FINAL["validate_without_parent"] = "SELECT * FROM q_no_parent"
FINAL["validate_no_parameters"] = f"""
SELECT count(product_id) AS n_rows FROM v_parameters WHERE {_E_RUN} AND profile = '9' HAVING count(*) = 0"""
FINAL["validation_report"] = """
SELECT 'No hay parametros' AS message WHERE NOT EXISTS (SELECT 1 FROM q_rows_2)
UNION ALL SELECT 'Los Cuc No Existen en DWH_DPRODUCTO :: ' || string_agg(product_id, ',' ORDER BY product_id) FROM q_missing HAVING count(*) > 0
UNION ALL SELECT 'Error Ind.Padre' WHERE EXISTS (SELECT 1 FROM q_parents)
UNION ALL SELECT 'CUV repetido' WHERE EXISTS (SELECT 1 FROM q_codes)
UNION ALL SELECT 'Vinculos sin Indicador Padre' WHERE EXISTS (SELECT 1 FROM q_no_parent)"""
FINAL["validation_report_estimation"] = f"""
SELECT 'No hay parametros' AS message
 WHERE NOT EXISTS (SELECT 1 FROM v_estimation WHERE {_E_RUN} AND profile = '9')"""


# ---- seller base ---------------------------------------------------------------
def _base(tag: str, p: int) -> None:
    CTES[f"q_new{tag}"] = f"""
SELECT DISTINCT s.seller_id FROM v_seller s JOIN v_status t USING (seller_id)
 WHERE s.enrol_cycle BETWEEN {p - 3} AND {p} AND s.seller_id NOT IN (SELECT seller_id FROM v_profile)"""
    CTES[f"q_ordering{tag}"] = f"""
SELECT seller_id, sum(net) AS net_sales FROM v_sales JOIN v_offer_kind USING (offer_kind)
 WHERE cycle BETWEEN {p - 2} AND {p} AND profit_kind = '01' AND cycle = ref_cycle
 GROUP BY 1 HAVING sum(net) > 0"""
    CTES[f"q_fifth{tag}"] = f"""
SELECT DISTINCT s.seller_id FROM v_seller s JOIN v_status t USING (seller_id)
 WHERE s.enrol_cycle BETWEEN {p - 5} AND {p - 4}"""
    CTES[f"q_kinds{tag}"] = f"""
SELECT seller_id, 'N' AS kind FROM q_new{tag}
UNION ALL SELECT DISTINCT seller_id, 'E' FROM (SELECT seller_id FROM q_ordering{tag} UNION SELECT seller_id FROM q_fifth{tag})
 WHERE seller_id NOT IN (SELECT seller_id FROM q_new{tag})"""
    CTES[f"q_base{tag}"] = f"""
SELECT k.seller_id, g.region_id, g.region, g.zone, t.segment, {text(str(p))} AS process_cycle, 'X' AS profile,
 abs({p} - s.enrol_cycle) + 1 AS seniority, k.kind
 FROM q_kinds{tag} k JOIN v_seller s USING (seller_id) JOIN v_status t ON t.seller_id = k.seller_id AND t.cycle = {p}
 JOIN v_geo g ON g.territory = t.territory"""


_base("", P)
_base("_n", PN)
FINAL["base_new"] = "SELECT * FROM q_new_n"
FINAL["base_new_all"] = f"""
SELECT DISTINCT seller_id FROM v_seller JOIN v_status USING (seller_id) WHERE enrol_cycle BETWEEN {PN - 3} AND {PN}"""
FINAL["base_ordering"] = "SELECT * FROM q_ordering"
FINAL["base_fifth_sixth"] = "SELECT * FROM q_fifth_n"
FINAL["base_info"] = "SELECT * FROM q_base"
FINAL["base_info_new_run"] = "SELECT * FROM q_base_n"
FINAL["base_profiled"] = f"""
SELECT s.seller_id, g.region_id, g.region, g.zone, t.segment, '200110' AS process_cycle, '2' AS profile,
 abs({P} - s.enrol_cycle) + 1 AS seniority, 'E' AS kind
 FROM v_profile p JOIN v_seller s USING (seller_id) JOIN v_status t ON t.seller_id = s.seller_id AND t.cycle = {P}
 JOIN v_geo g ON g.territory = t.territory WHERE p.profile = 2"""
CTES["q_est"] = """
SELECT b.*, p.profile AS peer_profile FROM q_base b LEFT JOIN v_profile p USING (seller_id) WHERE b.kind = 'E'"""
FINAL["base_peer_profile"] = "SELECT * FROM q_est"

# ---- products, sales, status ---------------------------------------------------
CTES["q_items"] = """
SELECT o.offer_type, o.offer_id, o.product_id, o.units, p.descr, o.price, p.brand, p.item_id, o.flag_top
 FROM q_offers o JOIN v_product p USING (product_id)"""
CTES["q_oproducts"] = """
SELECT o.product_id, offer_type, offer_id, sales_code, units, price, parent, flag_top, max(p.descr) AS descr,
 max(p.brand) AS brand, max(p.category) AS category, max(limit_units) AS limit_units,
 max(flag_last_minute) AS flag_last_minute
 FROM q_offers o JOIN v_product p USING (product_id) WHERE p.descr IS NOT NULL GROUP BY 1,2,3,4,5,6,7,8"""


def _codes(tag: str, x: int) -> None:
    CTES[f"q_coded{tag}"] = f"""
SELECT o.*, coalesce((SELECT CAST(min(c.item_id) AS VARCHAR) FROM v_catalog c JOIN q_oproducts b ON b.sales_code = c.sales_code
  WHERE c.cycle = {x} AND b.product_id = o.product_id AND c.item_id IN (SELECT item_id FROM v_product)), '') AS item_code
 FROM q_oproducts o"""


_codes("", X)
_codes("_n", XN)
CTES["q_units"] = "SELECT offer_id, sum(units) AS total_units FROM q_oproducts GROUP BY 1"
FINAL["offer_items"] = "SELECT * FROM q_items"
FINAL["offer_products"] = "SELECT * FROM q_oproducts"
FINAL["item_codes"] = "SELECT offer_id, product_id, item_code FROM q_coded"
FINAL["offer_units"] = "SELECT * FROM q_units"
FINAL["status_history"] = f"SELECT * FROM v_status WHERE cycle BETWEEN {S} AND {P}"
CTES["q_status"] = f"""
SELECT t.* FROM v_status t JOIN q_est b USING (seller_id) WHERE t.cycle BETWEEN {S} AND {P}"""
FINAL["base_status"] = "SELECT * FROM q_status"
CTES["q_activity"] = f"""
SELECT seller_id, count(DISTINCT cycle) FILTER (flag_order = 1) AS ordered_cycles,
 max(CASE WHEN cycle BETWEEN {R6} AND {P} AND channel IN ('WEB','WMX') THEN 1 ELSE 0 END) AS web_recent,
 max(flag_active) FILTER (cycle = {P}) AS active_now, max(segment) FILTER (cycle = {P}) AS segment_now
 FROM q_status GROUP BY 1"""
FINAL["seller_activity"] = "SELECT * FROM q_activity"
CTES["q_valid"] = f"""
SELECT f.* FROM v_sales f JOIN v_offer_kind k USING (offer_kind)
 WHERE f.cycle BETWEEN {S} AND {P} AND f.cycle = f.ref_cycle AND k.profit_kind = '01'
 AND f.offer_kind NOT IN ('030','040','051') AND f.net > 0
 AND f.seller_id IN (SELECT seller_id FROM q_base) AND f.item_id IN (SELECT item_id FROM q_items)"""
FINAL["valid_sales"] = "SELECT * FROM q_valid"


# ---- RFM of both offer types ----------------------------------------------------
def _rfm(tag: str, offer_type: str) -> None:
    CTES[f"q_products{tag}"] = f"""
SELECT offer_id, offer_type, product_id, units, price AS list_price, flag_top, max(descr) AS descr FROM q_items
 WHERE offer_type = '{offer_type}' AND descr IS NOT NULL GROUP BY 1,2,3,4,5,6"""
    CTES[f"q_sales{tag}"] = f"""
SELECT v.cycle, v.seller_id, v.item_id, v.offer_kind, v.territory, v.invoice, v.sales_code, v.units, v.net,
 i.offer_id, i.product_id FROM q_valid v JOIN q_items i USING (item_id) WHERE i.offer_type = '{offer_type}'"""

    def window(lo, hi):
        return f"coalesce(sum(net) FILTER (cycle BETWEEN {lo} AND {hi}), 0)"
    CTES[f"q_history{tag}"] = f"""
SELECT seller_id, offer_id, product_id, {window(P - 5, P)} AS sales_6c, {window(P - 11, P - 6)} AS sales_prev6,
 {window(P - 23, P - 18)} AS sales_6c_ly, count(DISTINCT cycle) AS frequency_24c, {P} - max(cycle) AS recency_24c,
 sum(net) AS sales_24c, {div('sum(net)', 'count(DISTINCT cycle)')} AS mean_24c, count(*) AS lines,
 CASE WHEN count(*) > 1 THEN {div(f'23 - (min(cycle) - {S}) - ({P} - max(cycle))', 'count(*) - 1')} END AS repurchase_cycle
 FROM q_sales{tag} GROUP BY 1,2,3 HAVING sum(net) > 0"""
    CTES[f"q_enough{tag}"] = f"""
SELECT s.seller_id, s.offer_id, s.product_id, s.item_id, s.cycle, sum(s.net) AS net
 FROM q_sales{tag} s JOIN q_products{tag} p USING (offer_id, product_id) WHERE s.units >= p.units
 GROUP BY 1,2,3,4,5 HAVING sum(s.net) > 0"""
    vehicles = "" if offer_type == "Bundle" else "AND c.vehicle IN ('REVISTA','CATÁLOGO','CATALOGO')"
    CTES[f"q_pcat{tag}"] = f"""
SELECT i.offer_id, i.product_id, c.item_id, c.cycle, c.offer_kind, c.sales_code, c.price
 FROM v_catalog c JOIN q_items i USING (item_id) JOIN v_offer_kind k ON k.offer_kind = c.offer_kind
 WHERE i.offer_type = '{offer_type}' AND c.cycle BETWEEN {S} AND {P} AND c.price > 0 AND k.profit_kind = '01'
 AND k.offer_kind NOT IN ('030','040','051') {vehicles}"""
    CTES[f"q_exposed{tag}"] = f"""
SELECT s.seller_id, s.offer_id, s.product_id, c.price, count(DISTINCT c.cycle) AS exposures
 FROM (SELECT DISTINCT seller_id, offer_id, product_id, item_id FROM q_sales{tag}) s
 JOIN q_pcat{tag} c ON c.item_id = s.item_id
 JOIN q_status t ON t.seller_id = s.seller_id AND t.cycle = c.cycle AND t.flag_order = 1 GROUP BY 1,2,3,4"""
    CTES[f"q_pure{tag}"] = f"""
SELECT s.seller_id, s.offer_id, s.product_id, c.price, count(DISTINCT c.cycle) AS pure_orders
 FROM q_sales{tag} s JOIN q_pcat{tag} c USING (cycle, item_id, offer_kind, sales_code) GROUP BY 1,2,3,4"""
    CTES[f"q_prices{tag}"] = f"""
SELECT e.*, coalesce(u.pure_orders, 0) AS pure_orders, {div('coalesce(u.pure_orders, 0)', 'e.exposures')} AS probability
 FROM q_exposed{tag} e LEFT JOIN q_pure{tag} u USING (seller_id, offer_id, product_id, price)"""
    CTES[f"q_optimal{tag}"] = f"""
SELECT seller_id, offer_id, product_id, price AS optimal_price FROM (SELECT *, row_number() OVER
  (PARTITION BY seller_id, offer_id, product_id ORDER BY probability DESC, pure_orders DESC, price ASC) AS n FROM q_prices{tag})
 WHERE n = 1"""
    CTES[f"q_minprice{tag}"] = f"SELECT offer_id, product_id, min(price) AS min_price FROM q_prices{tag} GROUP BY 1,2"


_rfm("", "Individual")
_rfm("_b", "Bundle")
CTES["q_listed"] = """
SELECT DISTINCT s.product_id, s.cycle FROM q_sales s JOIN v_catalog c USING (item_id, cycle, offer_kind, sales_code)"""
CTES["q_listed_ordered"] = """
SELECT h.seller_id, h.offer_id, h.product_id, count(DISTINCT t.cycle) AS listed_cycles
 FROM q_history h JOIN q_listed l USING (product_id)
 JOIN q_status t ON t.seller_id = h.seller_id AND t.cycle = l.cycle AND t.flag_order = 1 GROUP BY 1,2,3"""
CTES["q_orders_enough"] = """
SELECT seller_id, offer_id, product_id, count(DISTINCT cycle) AS enough_orders FROM q_enough GROUP BY 1,2,3"""
CTES["q_trigger"] = f"""
SELECT e.seller_id, e.offer_id, e.product_id, {div('e.enough_orders', 'l.listed_cycles')} AS trigger_rate
 FROM q_orders_enough e JOIN q_listed_ordered l USING (seller_id, offer_id, product_id)"""
FINAL["single_products"] = "SELECT * FROM q_products"
FINAL["single_sales"] = "SELECT * FROM q_sales"
FINAL["sales_windows_6"] = "SELECT * FROM q_history"
FINAL["rfm_single_24"] = "SELECT * FROM q_history"
FINAL["orders_enough_units"] = "SELECT * FROM q_orders_enough"
FINAL["listed_cycles"] = "SELECT * FROM q_listed"
FINAL["ordered_cycles"] = "SELECT DISTINCT seller_id, cycle FROM q_status WHERE flag_order = 1"
FINAL["listed_and_ordered"] = "SELECT * FROM q_listed_ordered"
FINAL["trigger_rate"] = "SELECT * FROM q_trigger"
FINAL["price_catalog"] = "SELECT * FROM q_pcat"
FINAL["price_exposure"] = "SELECT * FROM q_prices"
FINAL["optimal_price"] = "SELECT * FROM q_optimal"
FINAL["price_minimum"] = "SELECT * FROM q_minprice"


def _d(x: str) -> str:
    return f"coalesce(CAST({x} AS DOUBLE), 0)"


CTES["q_grid"] = f"""
SELECT b.seller_id, b.region_id, b.segment, b.seniority, b.peer_profile, p.offer_id, p.offer_type, p.product_id, p.flag_top, p.list_price, p.units,
 {_d('h.sales_6c')} AS sales_6c, {_d('h.sales_prev6')} AS sales_prev6, {_d('h.sales_6c_ly')} AS sales_6c_ly,
 {_d('h.sales_24c')} AS sales_24c, {_d('h.mean_24c')} AS mean_24c, {_d('h.frequency_24c')} AS frequency_24c,
 {_d('h.recency_24c')} AS recency_24c, 0.0::DOUBLE AS repurchase_cycle, 0.0::DOUBLE AS repurchase_gap, 0.0::DOUBLE AS min_sale_6c,
 {_d('o.optimal_price')} AS optimal_price, {_d('t.trigger_rate')} AS trigger_rate, 0.0::DOUBLE AS min_price,
 CASE WHEN h.seller_id IS NULL THEN 0 ELSE 1 END AS flag_bought
 FROM q_est b CROSS JOIN q_products p LEFT JOIN q_history h USING (seller_id, offer_id, product_id)
 LEFT JOIN q_trigger t USING (seller_id, offer_id, product_id) LEFT JOIN q_optimal o USING (seller_id, offer_id, product_id)"""
FINAL["grid_single"] = "SELECT * FROM q_grid"

# ---- bundles -------------------------------------------------------------------
CTES["q_sizes"] = "SELECT offer_id, offer_type, count(product_id) AS n_products FROM q_products_b GROUP BY 1,2"
CTES["q_complete"] = """
SELECT s.seller_id, s.offer_id, s.cycle, sum(s.net) AS net FROM q_sales_b s JOIN q_sizes z USING (offer_id)
 GROUP BY 1,2,3,z.n_products HAVING sum(s.net) > 0 AND count(DISTINCT s.product_id) = z.n_products"""
CTES["q_bundle_min"] = f"SELECT seller_id, offer_id, min(net) AS min_sale_6c FROM q_complete WHERE cycle >= {R6} GROUP BY 1,2"
CTES["q_bundle_totals"] = f"""
SELECT seller_id, offer_id, sum(net) AS sales_24c, {P} - max(cycle) AS recency_24c, count(DISTINCT cycle) AS frequency_24c
 FROM q_complete GROUP BY 1,2"""
CTES["q_bundle_enough"] = """
SELECT seller_id, offer_id, count(cycle) AS enough_orders FROM (
  SELECT e.seller_id, e.offer_id, e.cycle FROM q_enough_b e JOIN q_sizes z USING (offer_id)
  GROUP BY 1,2,3,z.n_products HAVING count(DISTINCT e.product_id) = z.n_products) GROUP BY 1,2"""
CTES["q_bundle_listed"] = """
SELECT i.offer_id, c.cycle FROM q_items i JOIN v_catalog c USING (item_id) JOIN q_sizes z ON z.offer_id = i.offer_id
 WHERE i.offer_type = 'Bundle' GROUP BY 1,2,z.n_products HAVING count(DISTINCT i.product_id) = z.n_products"""
CTES["q_bundle_lo"] = """
SELECT v.seller_id, v.offer_id, count(DISTINCT l.cycle) AS listed_cycles FROM q_bundle_totals v JOIN q_bundle_listed l USING (offer_id)
 JOIN q_status t ON t.seller_id = v.seller_id AND t.cycle = l.cycle AND t.flag_order = 1 GROUP BY 1,2"""
CTES["q_bundle_trigger"] = f"""
SELECT e.seller_id, e.offer_id, {div('e.enough_orders', 'l.listed_cycles')} AS trigger_rate
 FROM q_bundle_enough e JOIN q_bundle_lo l USING (seller_id, offer_id) JOIN q_bundle_totals v USING (seller_id, offer_id)"""
CTES["q_grid_b"] = f"""
SELECT b.seller_id, b.region_id, b.segment, b.seniority, b.peer_profile, p.offer_id, p.offer_type, p.product_id, p.flag_top, p.list_price, p.units,
 {_d('h.sales_6c')} AS sales_6c, {_d('h.sales_prev6')} AS sales_prev6, {_d('h.sales_6c_ly')} AS sales_6c_ly,
 {_d('h.sales_24c')} AS sales_24c, {_d(div('v.sales_24c', 'v.frequency_24c'))} AS mean_24c, {_d('v.frequency_24c')} AS frequency_24c,
 {_d('v.recency_24c')} AS recency_24c, {_d('h.repurchase_cycle')} AS repurchase_cycle,
 CASE WHEN h.seller_id IS NULL THEN 0 ELSE {_d('h.repurchase_cycle')} - h.recency_24c END AS repurchase_gap,
 {_d('m.min_sale_6c')} AS min_sale_6c, {_d('o.optimal_price')} AS optimal_price, {_d('t.trigger_rate')} AS trigger_rate,
 {_d('x.min_price')} AS min_price, CASE WHEN v.seller_id IS NULL THEN 0 ELSE 1 END AS flag_bought
 FROM q_est b CROSS JOIN q_products_b p LEFT JOIN q_history_b h USING (seller_id, offer_id, product_id)
 LEFT JOIN q_optimal_b o USING (seller_id, offer_id, product_id) LEFT JOIN q_minprice_b x USING (offer_id, product_id)
 LEFT JOIN q_bundle_totals v USING (seller_id, offer_id) LEFT JOIN q_bundle_trigger t USING (seller_id, offer_id)
 LEFT JOIN q_bundle_min m USING (seller_id, offer_id)"""
FINAL["bundle_products"] = "SELECT * FROM q_products_b"
FINAL["bundle_sales"] = "SELECT * FROM q_sales_b"
FINAL["bundle_rfm_24"] = "SELECT * FROM q_history_b"
FINAL["repurchase_cycle"] = "SELECT * FROM q_history_b WHERE lines > 1"
FINAL["bundle_sizes"] = "SELECT * FROM q_sizes"
FINAL["bundle_complete_cycles"] = "SELECT * FROM q_complete"
FINAL["bundle_min_sale"] = "SELECT * FROM q_bundle_min"
FINAL["bundle_totals"] = "SELECT * FROM q_bundle_totals"
FINAL["bundle_enough_units"] = "SELECT * FROM q_bundle_enough"
FINAL["bundle_listed_and_ordered"] = "SELECT * FROM q_bundle_lo"
FINAL["bundle_trigger"] = "SELECT * FROM q_bundle_trigger"
FINAL["bundle_price_catalog"] = "SELECT * FROM q_pcat_b"
FINAL["bundle_price_exposure"] = "SELECT * FROM q_prices_b"
FINAL["bundle_optimal_price"] = "SELECT * FROM q_optimal_b"
FINAL["bundle_price_minimum"] = "SELECT * FROM q_minprice_b"
FINAL["grid_bundle"] = "SELECT * FROM q_grid_b"

# ---- new sellers ---------------------------------------------------------------
CTES["q_npurchases"] = f"""
SELECT DISTINCT f.cycle, f.seller_id, i.offer_id, i.product_id FROM v_sales f JOIN q_items i USING (item_id)
 JOIN v_catalog c ON c.cycle = f.cycle AND c.item_id = f.item_id JOIN v_offer_kind k ON k.offer_kind = f.offer_kind
 WHERE f.cycle BETWEEN {SN} AND {PN} AND f.cycle = f.ref_cycle AND k.profit_kind = '01'
 AND k.offer_kind NOT IN ('030','040','051') AND f.net > 0"""
CTES["q_entrants"] = f"""
SELECT t.seller_id, t.cycle, t.behaviour, s.enrol_cycle FROM v_status t JOIN v_seller s USING (seller_id)
 WHERE s.enrol_cycle BETWEEN {SN} AND {PN} AND t.cycle <= {PN}"""
CTES["q_after_new"] = "SELECT seller_id, max(cycle) + 1 AS next_cycle FROM q_entrants WHERE behaviour = 'Nuevas' GROUP BY 1"
CTES["q_next"] = """
SELECT DISTINCT a.seller_id, e.cycle, CASE WHEN e.behaviour IN ('Constantes 1','Constantes 2') THEN 'Constantes' ELSE 'Inconstantes' END AS behaviour
 FROM q_after_new a JOIN q_entrants e ON e.seller_id = a.seller_id AND e.cycle = a.next_cycle
 WHERE e.behaviour IN ('Constantes 1','Constantes 2','Inconstantes')"""
CTES["q_totals"] = "SELECT behaviour, count(DISTINCT seller_id) AS total_sellers FROM q_next GROUP BY 1"


def _penetration(keys: str) -> str:
    def n(b):
        return f"count(DISTINCT seller_id) FILTER (behaviour = '{b}')"

    def total(b):
        return f"(SELECT total_sellers FROM q_totals WHERE behaviour = '{b}')"
    return f"""
SELECT {keys}, {n('Constantes')} AS n_const, {n('Inconstantes')} AS n_inconst,
 coalesce({div(n('Constantes'), total('Constantes'))}, 0) AS pen_const,
 coalesce({div(n('Inconstantes'), total('Inconstantes'))}, 0) AS pen_inconst
 FROM (SELECT f.*, b.behaviour FROM q_npurchases f JOIN q_next b ON b.seller_id = f.seller_id
  AND f.cycle BETWEEN b.cycle AND b.cycle + 2) GROUP BY {keys}"""


CTES["q_pen"] = _penetration("offer_id")
CTES["q_nbase"] = "SELECT seller_id FROM q_base_n WHERE kind = 'N'"
CTES["q_nfreq"] = f"""
SELECT f.seller_id, f.offer_id, count(DISTINCT f.cycle) AS frequency FROM q_npurchases f JOIN q_nbase USING (seller_id)
 WHERE f.cycle BETWEEN {PN - 3} AND {PN} GROUP BY 1,2"""
_PEN = ("CASE WHEN coalesce(e.pen_inconst, 0) = 0 THEN 0 ELSE e.pen_const / e.pen_inconst END"
        " * (coalesce(e.pen_const, 0) + coalesce(e.pen_inconst, 0)) / 2")
CTES["q_ngrid"] = f"""
SELECT b.seller_id, o.offer_id, o.product_id, o.flag_top, CAST(o.price AS DOUBLE) AS price, o.units,
 coalesce(CAST(f.frequency AS DOUBLE), 0) AS frequency, coalesce(e.pen_const, 0) AS pen_const,
 coalesce(e.pen_inconst, 0) AS pen_inconst, {_PEN} AS penetration
 FROM q_nbase b CROSS JOIN q_oproducts o LEFT JOIN q_pen e USING (offer_id)
 LEFT JOIN q_nfreq f ON f.seller_id = b.seller_id AND f.offer_id = o.offer_id"""


def _row_z(table: str, columns: dict[str, str]) -> str:
    """Z-scores with the mean over rows, statistics rounded to 4."""
    stats = ", ".join(f"{rnd(avg(c), 4)} AS m_{c}, {rnd(f'stddev_pop({c})', 4)} AS s_{c}" for c in columns.values())
    zs = ", ".join(f"CASE WHEN s_{c} = 0 THEN 0 ELSE {rnd(f'({c} - m_{c}) / NULLIF(s_{c}, 0)', 4)} END AS {z}"
                   for z, c in columns.items())
    return f"SELECT t.*, {zs} FROM {table} t CROSS JOIN (SELECT {stats} FROM {table})"


CTES["q_nz"] = _row_z("q_ngrid", {"frequency_z": "frequency", "penetration_z": "penetration", "price_z": "price"})
CTES["q_nscore"] = "SELECT *, penetration_z - frequency_z AS score FROM q_nz"
CTES["q_nscorez"] = _row_z("q_nscore", {"score_z": "score"})
CTES["q_nprob"] = "SELECT *, exp(score_z + price_z) / (exp(score_z + price_z) + 1) * units AS probability FROM q_nscorez"
CTES["q_comp0"] = f"""
SELECT o.offer_type, o.offer_id, o.product_id, o.flag_top, o.units, CAST(o.price AS DOUBLE) AS price,
 coalesce(e.pen_const, 0) AS pen_const, coalesce(e.pen_inconst, 0) AS pen_inconst, {_PEN} AS penetration
 FROM q_oproducts o LEFT JOIN q_pen e USING (offer_id)"""
CTES["q_comp1"] = _row_z("q_comp0", {"price_z": "price", "penetration_z": "penetration"})
CTES["q_comp2"] = "SELECT *, penetration_z + price_z AS score FROM q_comp1"
CTES["q_comp3"] = _row_z("q_comp2", {"score_z": "score"})
CTES["q_comp"] = "SELECT *, exp(score_z) / (exp(score_z) + 1) * units AS purchase_probability FROM q_comp3"
FINAL["new_purchases"] = "SELECT * FROM q_npurchases"
FINAL["new_entrants"] = "SELECT * FROM q_entrants"
FINAL["cycle_after_new"] = "SELECT * FROM q_after_new"
FINAL["next_behaviour"] = "SELECT * FROM q_next"
FINAL["behaviour_totals"] = "SELECT * FROM q_totals"
FINAL["penetration"] = _penetration("offer_id, product_id")
FINAL["new_frequency"] = f"""
SELECT f.seller_id, f.offer_id, f.product_id, count(DISTINCT f.cycle) AS frequency FROM q_npurchases f
 JOIN q_nbase USING (seller_id) WHERE f.cycle BETWEEN {PN - 3} AND {PN} GROUP BY 1,2,3"""
FINAL["new_grid"] = "SELECT * FROM q_ngrid"
FINAL["new_probability"] = "SELECT * FROM q_nprob"
FINAL["new_probability_table"] = """
SELECT 'C1' AS country, '199612' AS process_cycle, '199613' AS target_cycle, seller_id, offer_id, flag_top, probability,
 'N' AS kind, 'ODD' AS personalisation, 0 AS engine, 'X' AS profile FROM q_nprob"""
FINAL["offer_complement"] = "SELECT * FROM q_comp"


# ---- peer groups ---------------------------------------------------------------
def _peers(tag: str, suffix: str, keys: list[str], digits: int) -> None:
    k = ", ".join(keys)
    region = tag == ""

    def on(a, b, extra=()):
        return " AND ".join(f"{a}.{c} = {b}.{c}" for c in [*keys, *extra])

    product, offer = ("offer_id", "product_id"), ("offer_id",)
    CTES[f"q_size{tag}"] = f"SELECT {k}, count(DISTINCT seller_id) AS group_sellers FROM q_est GROUP BY {k}"
    if region:
        groups, source = "g.region_id, a.segment_now AS segment", "JOIN v_geo g ON g.territory = s.territory"
    else:
        groups, source = "b.peer_profile", "JOIN q_est b ON b.seller_id = s.seller_id"
    CTES[f"q_pot{tag}"] = f"""
SELECT {groups}, s.seller_id, s.offer_id, s.product_id, s.cycle, s.invoice, sum(s.net) AS potential, max(a.web_recent) AS web_recent
 FROM q_sales s JOIN q_activity a ON a.seller_id = s.seller_id AND a.active_now = 1 {source}
 GROUP BY ALL HAVING sum(s.net) > 0"""
    recent = f"web_recent = 1 AND cycle BETWEEN {R6} AND {P}"
    CTES[f"q_ps{tag}"] = f"""
SELECT {k}, offer_id, product_id, seller_id, min(potential) FILTER ({recent}) AS min_sale,
 count(DISTINCT cycle) FILTER ({recent}) AS pure_6c, {P} - max(cycle) FILTER (web_recent = 1) AS recency,
 count(DISTINCT cycle) FILTER (web_recent = 1) AS pure_24c,
 CASE WHEN count(*) > 1 THEN {div(f'23 - (min(cycle) - {S}) - ({P} - max(cycle))', 'count(*) - 1')} END AS repurchase_cycle
 FROM q_pot{tag} GROUP BY {k}, offer_id, product_id, seller_id"""
    CTES[f"q_pr{tag}"] = f"""
SELECT t.*, {rnd(div('t.total', 'z.group_sellers'), 2)} AS min_sale FROM (
  SELECT {k}, offer_id, product_id, {avg('min_sale')} AS buyer_min_sale, {rnd(avg('pure_6c'), 1)} AS frequency_6c,
   sum(min_sale) AS total FROM q_ps{tag} WHERE pure_6c > 0 GROUP BY {k}, offer_id, product_id) t
 JOIN q_size{tag} z ON {on('t', 'z')}"""
    CTES[f"q_buyers{tag}"] = f"""
SELECT {k}, offer_id, product_id, {avg('recency')} AS buyer_recency,
 CAST(ceil({rnd(avg('pure_24c'), digits)}) AS BIGINT) AS buyer_frequency
 FROM q_ps{tag} WHERE pure_24c > 0 GROUP BY {k}, offer_id, product_id"""
    CTES[f"q_cyclegp{tag}"] = f"""
SELECT {k}, offer_id, product_id, CAST(ceil({avg('repurchase_cycle')}) AS BIGINT) AS repurchase_cycle
 FROM q_ps{tag} WHERE repurchase_cycle IS NOT NULL GROUP BY {k}, offer_id, product_id"""
    CTES[f"q_priced{tag}"] = f"""
SELECT {', '.join('s.' + c for c in keys)}, s.offer_id, s.product_id, sum(s.pure_24c) AS tp,
 sum(CASE WHEN s.recency = 0 THEN 24 ELSE s.recency END) AS tr, sum(o.optimal_price) AS tpr, count(*) AS n
 FROM q_ps{tag} s JOIN q_optimal o USING (seller_id, offer_id, product_id) WHERE s.pure_24c > 0 GROUP BY ALL"""
    rest = "(z.group_sellers - t.n)"
    CTES[f"q_ph{tag}"] = f"""
SELECT b.*, coalesce(t.n, 0) AS priced_buyers, z.group_sellers, coalesce(c.repurchase_cycle, 0) AS repurchase_cycle,
 CASE WHEN t.n IS NOT NULL AND z.group_sellers > 0 THEN {rnd(div('t.tp', 'z.group_sellers'), 2)} ELSE b.buyer_frequency END AS frequency,
 CASE WHEN t.n IS NOT NULL AND z.group_sellers > 0 THEN {div(f'(t.tr + 24 * {rest})', 'z.group_sellers')} ELSE b.buyer_recency END AS recency,
 CASE WHEN t.n IS NOT NULL AND z.group_sellers > 0 THEN {div(f'(t.tpr + m.min_price * {rest})', 'z.group_sellers')} ELSE 0 END AS optimal_price
 FROM q_buyers{tag} b LEFT JOIN q_cyclegp{tag} c ON {on('b', 'c', product)} LEFT JOIN q_priced{tag} t ON {on('b', 't', product)}
 JOIN q_size{tag} z ON {on('b', 'z')} LEFT JOIN q_minprice m ON m.offer_id = b.offer_id AND m.product_id = b.product_id"""

    def peer(own, theirs):
        return f"CASE WHEN g.flag_bought = 0 THEN coalesce({theirs}, g.{own}) ELSE g.{own} END AS {own}"
    CTES[f"q_fill0{tag}"] = f"""
SELECT g.* REPLACE (coalesce(CAST(h.repurchase_cycle AS DOUBLE), g.repurchase_cycle) AS repurchase_cycle,
  coalesce(r.min_sale, g.min_sale_6c) AS min_sale_6c, {peer('frequency_24c', 'h.frequency')},
  {peer('recency_24c', 'h.recency')}, {peer('optimal_price', 'h.optimal_price')})
 FROM q_grid g LEFT JOIN q_ph{tag} h ON {on('g', 'h', product)} LEFT JOIN q_pr{tag} r ON {on('g', 'r', product)}"""
    CTES[f"q_avg{tag}"] = f"""
SELECT {k}, offer_id, {avg('trigger_rate')} AS trigger_rate, {avg('frequency_24c')} AS frequency_24c
 FROM q_fill0{tag} GROUP BY {k}, offer_id"""
    CTES[f"q_fill{tag}"] = f"""
SELECT g.* REPLACE (CASE WHEN g.flag_bought = 0 THEN coalesce(a.trigger_rate, g.trigger_rate) ELSE g.trigger_rate END AS trigger_rate)
 FROM q_fill0{tag} g LEFT JOIN q_avg{tag} a ON {on('g', 'a', offer)}"""
    CTES[f"q_bp{tag}"] = f"""
SELECT {k}, offer_id, product_id, CAST(ceil({avg('repurchase_cycle')}) AS BIGINT) AS repurchase_cycle, {avg('min_price')} AS min_price
 FROM q_grid_b GROUP BY {k}, offer_id, product_id"""
    CTES[f"q_bflag{tag}"] = f"""
SELECT g.* REPLACE (coalesce(CAST(p.repurchase_cycle AS DOUBLE), g.repurchase_cycle) AS repurchase_cycle,
  CASE WHEN g.optimal_price = 0 THEN coalesce(p.min_price, g.optimal_price) ELSE g.optimal_price END AS optimal_price),
 CASE WHEN g.repurchase_gap > 0 THEN 1 ELSE 0 END AS flag_overdue,
 CASE WHEN g.sales_6c - g.sales_6c_ly <= 0 THEN 1 ELSE 0 END AS flag_below_last_year,
 CASE WHEN g.sales_6c - g.sales_prev6 <= 0 THEN 1 ELSE 0 END AS flag_below_previous
 FROM q_grid_b g LEFT JOIN q_bp{tag} p ON {on('g', 'p', product)}"""
    sums = ", ".join(f"sum({c}) AS {c}" for c in ("sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "repurchase_gap",
                                                  "optimal_price", "flag_overdue", "flag_below_last_year", "flag_below_previous"))
    means = ", ".join(f"{avg(c)} AS {c}" for c in ("mean_24c", "frequency_24c", "recency_24c", "repurchase_cycle",
                                                   "min_sale_6c", "trigger_rate", "flag_bought"))
    CTES[f"q_brolled{tag}"] = f"""
SELECT seller_id, region_id, segment, peer_profile, seniority, offer_type, offer_id, {sums}, {means},
 CASE WHEN {avg('recency_24c')} = 0 THEN 24 ELSE {avg('recency_24c')} END AS recency_or_24, {avg('mean_24c')} AS sales_gap,
 0.0::DOUBLE AS gap, CAST(sum(list_price) AS DOUBLE) - sum(optimal_price) AS price_gap, max(flag_top) AS flag_top
 FROM q_bflag{tag} GROUP BY 1,2,3,4,5,6,7"""

    def per_seller(c, cond=""):
        return f"{div(f'sum({c}) {cond}', f'count(DISTINCT seller_id) {cond}')} AS {c}"
    CTES[f"q_boffer{tag}"] = f"""
SELECT {k}, offer_id, {per_seller('min_sale_6c')}, {per_seller('frequency_24c')}, {avg('recency_or_24')} AS recency_24c,
 {per_seller('trigger_rate')}, {per_seller('price_gap', 'FILTER (price_gap <> 0)')}
 FROM q_brolled{tag} GROUP BY {k}, offer_id"""

    def zero(test, own, theirs):
        return f"CASE WHEN g.{test} = 0 THEN coalesce(p.{theirs}, g.{own}) ELSE g.{own} END AS {own}"
    recency = "g.recency_or_24 AS recency_24c" if region else zero("recency_24c", "recency_24c", "recency_24c")
    CTES[f"q_bfill{tag}"] = f"""
SELECT g.* REPLACE ({zero('sales_gap', 'sales_gap', 'min_sale_6c')}, {zero('frequency_24c', 'frequency_24c', 'frequency_24c')},
  {zero('trigger_rate', 'trigger_rate', 'trigger_rate')}, {zero('optimal_price', 'price_gap', 'price_gap')}, {recency})
 FROM q_brolled{tag} g LEFT JOIN q_boffer{tag} p ON {on('g', 'p', offer)}"""
    FINAL[f"peer_group_sizes_{suffix}"] = f"SELECT * FROM q_size{tag}"
    FINAL[f"peer_potential_sales_{suffix}"] = f"SELECT * FROM q_pot{tag}"
    FINAL[f"peer_sellers_{suffix}"] = f"SELECT * FROM q_ps{tag}"
    FINAL[f"peer_recent_{suffix}"] = f"SELECT * FROM q_pr{tag}"
    FINAL[f"peer_history_{suffix}"] = f"SELECT * FROM q_ph{tag}"
    FINAL[f"peer_fill_single_{suffix}"] = f"SELECT * FROM q_fill{tag}"
    FINAL[f"peer_offer_averages_{suffix}"] = f"SELECT * FROM q_avg{tag}"
    FINAL[f"peer_table_single_{suffix}"] = f"""
SELECT {', '.join('h.' + c for c in keys)}, h.offer_id, h.product_id, h.frequency AS frequency_24c, h.recency AS recency_24c,
 h.optimal_price, h.repurchase_cycle, r.min_sale AS min_sale_6c, a.trigger_rate
 FROM q_ph{tag} h JOIN q_pr{tag} r ON {on('h', 'r', product)} JOIN q_avg{tag} a ON {on('h', 'a', offer)}"""
    FINAL[f"peer_bundle_products_{suffix}"] = f"SELECT * FROM q_bp{tag}"
    FINAL[f"peer_bundle_flags_{suffix}"] = f"SELECT * FROM q_bflag{tag}"
    FINAL[f"peer_bundle_rollup_{suffix}"] = f"SELECT * FROM q_brolled{tag}"
    FINAL[f"peer_bundle_offers_{suffix}"] = f"SELECT * FROM q_boffer{tag}"
    FINAL[f"peer_fill_bundle_{suffix}"] = f"SELECT * FROM q_bfill{tag}"
    FINAL[f"peer_table_bundle_{suffix}"] = f"""
SELECT {', '.join('p.' + c for c in keys)}, p.offer_id, p.product_id, o.frequency_24c, o.recency_24c, p.min_price AS optimal_price,
 p.repurchase_cycle, o.min_sale_6c, o.trigger_rate FROM q_bp{tag} p JOIN q_boffer{tag} o ON {on('p', 'o', offer)}"""


_peers("", "segment", ["region_id", "segment"], 0)
_peers("_p", "profile", ["peer_profile"], 1)
FINAL["bundle_products_from_grid"] = """
SELECT DISTINCT g.offer_id, g.product_id, g.units, g.optimal_price AS price, g.flag_top, d.product_descr
 FROM q_grid_b g JOIN (SELECT product_id, max(descr) AS product_descr FROM v_product WHERE descr IS NOT NULL GROUP BY 1) d USING (product_id)"""
FINAL["bundle_price_gap"] = """
SELECT b.seller_id, b.offer_id, CAST(sum(p.list_price) AS DOUBLE) - sum(DISTINCT b.optimal_price) AS price_gap
 FROM q_brolled b JOIN q_products_b p USING (offer_id) GROUP BY 1,2"""

# ---- consolidation -------------------------------------------------------------
CTES["q_gift_items"] = """
SELECT g.offer_id, g.product_id, g.units, p.item_id, g.price FROM q_gifts g JOIN v_product p USING (product_id)"""
CTES["q_gift_value"] = f"""
WITH a AS (SELECT g.offer_id, g.product_id, g.item_id, g.units, max(c.normal_price) AS np FROM v_catalog c
  JOIN q_gift_items g USING (item_id) JOIN v_offer_kind k ON k.offer_kind = c.offer_kind WHERE c.normal_price > 0 GROUP BY 1,2,3,4),
 b AS (SELECT offer_id, product_id, units, units * {rnd(avg('np'), 2)} AS value FROM a GROUP BY 1,2,3)
SELECT b.offer_id, {div('sum(b.value)', 'sum(u.total_units)')} AS gift_gap FROM b JOIN q_units u USING (offer_id) GROUP BY 1"""
CTES["q_gift_orders"] = f"""
SELECT seller_id, count(DISTINCT cycle) AS gift_cycles FROM v_sales JOIN v_offer_kind USING (offer_kind)
 WHERE cycle BETWEEN {S} AND {P} AND cycle = ref_cycle AND profit_kind = '01' AND net = 0 AND units >= 1
 AND seller_id IN (SELECT seller_id FROM q_est) GROUP BY 1"""
CTES["q_gift_rate"] = f"""
SELECT g.seller_id, {div('g.gift_cycles', 'a.ordered_cycles')} AS gift_rate FROM q_gift_orders g
 JOIN q_activity a USING (seller_id) WHERE a.ordered_cycles > 0"""


def _gaps(tag: str) -> None:
    CTES[f"q_sgap{tag}"] = f"""
SELECT * REPLACE (recency_24c - repurchase_cycle AS repurchase_gap), {rnd('CAST(list_price AS DOUBLE) - optimal_price', 4)} AS price_gap,
 CASE WHEN sales_24c > 0 AND frequency_24c > 1 THEN sales_6c - CASE WHEN seniority > 24 THEN sales_6c_ly ELSE sales_prev6 END ELSE 0 END AS gap,
 CASE WHEN sales_24c <= 0 THEN min_sale_6c WHEN frequency_24c >= 1 THEN mean_24c ELSE 0 END AS sales_gap FROM q_fill{tag}"""
    sums = ", ".join(f"sum({c}) AS {c}" for c in ("sales_6c", "sales_prev6", "sales_6c_ly", "sales_24c", "repurchase_gap", "optimal_price"))
    means = ", ".join(f"{avg(c)} AS {c}" for c in ("mean_24c", "frequency_24c", "recency_24c", "repurchase_cycle", "min_sale_6c",
                                                   "gap", "sales_gap", "flag_bought", "price_gap", "trigger_rate"))
    cols = ("seller_id, region_id, segment, seniority, offer_type, offer_id, sales_6c, sales_prev6, sales_6c_ly, sales_24c,"
            " repurchase_gap, optimal_price, mean_24c, frequency_24c, recency_24c, repurchase_cycle, min_sale_6c, gap, sales_gap,"
            " flag_bought, price_gap, trigger_rate, flag_top")
    CTES[f"q_both{tag}"] = f"""
SELECT {cols} FROM (SELECT seller_id, region_id, segment, seniority, offer_type, offer_id, {sums}, {means}, max(flag_top) AS flag_top
  FROM q_sgap{tag} GROUP BY 1,2,3,4,5,6)
UNION ALL SELECT {cols} FROM q_bfill{tag}"""
    trigger = ("CASE WHEN b.offer_id IN (SELECT offer_id FROM q_gifts) THEN coalesce(sqrt(r.gift_rate) / 10, 0) ELSE 0 END")
    CTES[f"q_rfm{tag}"] = f"""
SELECT b.* REPLACE (b.price_gap - coalesce(v.gift_gap, 0) AS price_gap, b.trigger_rate + {trigger} AS trigger_rate),
 coalesce(v.gift_gap, 0) AS gift_gap, {trigger} AS gift_trigger, coalesce(u.total_units, 0) AS total_units, p.profile AS peer_profile,
 'C1' AS country, '200110' AS process_cycle, '200111' AS target_cycle, 'E' AS kind, 'SR' AS personalisation, 'X' AS profile
 FROM q_both{tag} b LEFT JOIN q_gift_value v USING (offer_id) LEFT JOIN q_gift_rate r USING (seller_id)
 LEFT JOIN q_units u USING (offer_id) LEFT JOIN v_profile p USING (seller_id)"""


_gaps("")
_gaps("_p")
FINAL["single_gaps"] = "SELECT * FROM q_sgap"
FINAL["gift_items"] = "SELECT * FROM q_gift_items"
FINAL["gift_value"] = "SELECT * FROM q_gift_value"
FINAL["gift_orders"] = "SELECT * FROM q_gift_orders"
FINAL["gift_trigger"] = "SELECT * FROM q_gift_rate"
FINAL["rfm_consolidated"] = "SELECT * FROM q_rfm"
FINAL["rfm_consolidated_profile"] = "SELECT * FROM q_rfm_p"

# ---- gap engine ----------------------------------------------------------------
_RULE = """CASE WHEN frequency_24c = 1 THEN CASE WHEN repurchase_gap > 0 THEN sales_24c ELSE -1 END
 WHEN frequency_24c > 1 AND seniority > 24 THEN CASE WHEN sales_6c - sales_6c_ly <= 0 THEN sales_24c ELSE -1 END
 WHEN seniority <= 24 AND sales_6c - sales_prev6 <= 0 THEN mean_24c ELSE -1 END"""


def _engine_gaps(tag: str, keys: list[str]) -> None:
    k = ", ".join(keys)
    CTES[f"q_gsingle{tag}"] = f"""
SELECT *, CASE WHEN sales_24c <= 0 THEN min_sale_6c ELSE {_RULE} END AS sales_gap_mc FROM q_rfm{tag} WHERE offer_type = 'Individual'"""
    CTES[f"q_gbundle{tag}"] = f"SELECT *, {_RULE} AS sales_gap_mc FROM q_rfm{tag} WHERE offer_type = 'Bundle'"
    match = " AND ".join(f"p.{c} = b.{c}" for c in [*keys, "offer_id"])
    CTES[f"q_gaps{tag}"] = f"""
SELECT * FROM q_gsingle{tag}
UNION ALL SELECT b.* REPLACE (CASE WHEN b.sales_gap_mc = 0 THEN coalesce(p.potential, b.sales_gap_mc) ELSE b.sales_gap_mc END AS sales_gap_mc)
 FROM q_gbundle{tag} b LEFT JOIN (SELECT {k}, offer_id, {div('sum(min_sale_6c)', 'count(DISTINCT seller_id)')} AS potential
  FROM q_gbundle{tag} GROUP BY {k}, offer_id) p ON {match}"""


_engine_gaps("", ["region_id", "segment"])
_engine_gaps("_p", ["peer_profile"])
_Z = {"frequency_z": "frequency_24c", "recency_z": "recency_24c", "sales_gap_z": "sales_gap",
      "sales_gap_mc_z": "sales_gap_mc", "price_gap_z": "price_gap", "trigger_z": "trigger_rate"}


def _seller_stats(cols, prefix=("mean_", "sd_")) -> str:
    return ", ".join(f"{rnd(div(f'sum({c})', 'count(DISTINCT seller_id)'), 4)} AS {prefix[0]}{c},"
                     f" {rnd(f'stddev_pop({c})', 4)} AS {prefix[1]}{c}" for c in cols)


def _z(c: str, cond: str) -> str:
    return f"CASE WHEN {cond} AND sd_{c} <> 0 THEN {rnd(f'({c} - mean_{c}) / NULLIF(sd_{c}, 0)', 4)} ELSE 0 END"


CTES["q_stats"] = f"SELECT {_seller_stats(_Z.values())} FROM q_gaps WHERE sales_gap >= 0"
CTES["q_z"] = f"""
SELECT g.*, {', '.join(f"{_z(c, 'sales_gap >= 0')} AS {z}" for z, c in _Z.items())} FROM q_gaps g CROSS JOIN q_stats"""


def _opp(gap: str) -> str:
    return rnd(f"frequency_z - recency_z + {gap} - price_gap_z + trigger_z", 4)


CTES["q_opp"] = f"SELECT *, {_opp('sales_gap_z')} AS opportunity, {_opp('sales_gap_mc_z')} AS opportunity_mc FROM q_z"
CTES["q_oppz"] = f"""
SELECT o.*, {_z('opportunity', 'sales_gap >= 0')} AS opportunity_z, {_z('opportunity_mc', 'sales_gap_mc >= 0')} AS opportunity_mc_z
 FROM q_opp o CROSS JOIN (SELECT {_seller_stats(['opportunity'])} FROM q_opp WHERE sales_gap >= 0)
 CROSS JOIN (SELECT {_seller_stats(['opportunity_mc'])} FROM q_opp WHERE sales_gap_mc >= 0)"""


def _score(x: str, gap: str) -> str:
    return f"CASE WHEN {gap} >= 0 THEN exp({x}) / (exp({x}) + 1) ELSE 0 END"


CTES["q_scored"] = f"""
SELECT *, {_score('opportunity_z', 'sales_gap')} AS score, {_score('opportunity_mc_z', 'sales_gap_mc')} AS score_mc,
 {_score('least(opportunity_z * total_units, 700)', 'sales_gap')} AS score_units,
 {_score('least(opportunity_mc_z * total_units, 700)', 'sales_gap_mc')} AS score_mc_units FROM q_oppz"""
FINAL["gap_single"] = "SELECT * FROM q_gsingle"
FINAL["gap_bundle"] = "SELECT * FROM q_gbundle"
FINAL["run_variables"] = f"SELECT r.*, p.profile AS peer_profile FROM ({FINAL['rfm_consolidated']}) r LEFT JOIN v_profile p ON p.seller_id = r.seller_id"
FINAL["gap_all"] = f"""
SELECT *, {rnd('sales_gap', 4)} AS sales_gap_round, {rnd('optimal_price', 4)} AS optimal_price_round,
 {rnd('sales_gap_mc', 4)} AS sales_gap_mc_round FROM q_gaps"""
FINAL["gap_all_profile"] = "SELECT * FROM q_gaps_p"
FINAL["engine_statistics"] = "SELECT * FROM q_stats"
FINAL["zscores"] = "SELECT * FROM q_z"
FINAL["opportunity"] = "SELECT * FROM q_opp"
FINAL["normalised_opportunity"] = "SELECT * FROM q_oppz"
FINAL["scores"] = "SELECT * FROM q_scored"
FINAL["rfm_scored"] = "SELECT *, 0 AS n_listings, 'A' AS official_profile, 0 AS flag_recommended FROM q_scored"


def _prob(score: str, engine: int, rules: str = "SR") -> str:
    return f"""
SELECT 'C1' AS country, '200110' AS process_cycle, '200111' AS target_cycle, seller_id, offer_id, flag_top, {score} AS probability,
 'E' AS kind, '{rules}' AS personalisation, {engine} AS engine, 'X' AS profile FROM q_scored"""


FINAL["probability_plain"] = _prob("score_units", 0)
FINAL["probability_engine"] = _prob("score_mc_units", 1)

# ---- showroom ranking ----------------------------------------------------------
CTES["q_plan"] = """
SELECT slots, top_slots, f AS fixed_slots, slots - f - top_slots AS free_slots FROM
 (SELECT coalesce(max(slots), 0) AS slots, coalesce(max(top_slots), 0) AS top_slots
   FROM v_estimation WHERE kind = 'E' AND personalisation = 'SR' AND process_cycle = '200110' AND target_cycle = '200111')
 CROSS JOIN (SELECT coalesce(max(slot), 0) AS f FROM v_forced WHERE forced_kind = 1)"""
FINAL["slot_plan"] = "SELECT * FROM q_plan"
FINAL["forced_slot_rows"] = "SELECT * FROM v_forced"
FINAL["fixed_slots"] = """
SELECT f.brand, f.category, f.slot, count(o.offer_id) AS n_offers FROM (SELECT DISTINCT brand, category, slot FROM v_forced WHERE forced_kind = 1) f
 LEFT JOIN q_oproducts o USING (brand, category) GROUP BY 1,2,3"""
FINAL["not_to_repeat"] = """
SELECT o.offer_id, o.product_id FROM q_oproducts o WHERE EXISTS (SELECT 1 FROM v_forced f WHERE f.forced_kind = 0
 AND f.brand = o.brand AND f.category = o.category)"""
_RANK = "row_number() OVER (PARTITION BY seller_id ORDER BY {0}probability DESC, offer_id)"


def _ranking(tag: str, source: str, established: bool) -> None:
    """Unrolled slot rules: forced slots 1-2, then up to 8 free picks."""
    CTES[f"q_cand{tag}"] = source
    CTES[f"q_rank{tag}"] = f"SELECT *, {_RANK.format('')} AS position FROM q_cand{tag}"
    keep = "WHERE position <> 3" if established else ""
    CTES[f"q_left{tag}"] = f"SELECT seller_id, offer_id, flag_top, probability FROM q_rank{tag} {keep}"
    CTES[f"q_top{tag}"] = f"""
SELECT seller_id, offer_id, probability, 'T' AS type FROM (SELECT *, {_RANK.format('')} AS n FROM q_left{tag} WHERE flag_top = 1)
 WHERE n <= (SELECT top_slots FROM q_plan)"""
    CTES[f"q_prop{tag}"] = f"""
SELECT l.seller_id, l.offer_id, l.probability, o.product_id, o.brand, o.category FROM q_left{tag} l JOIN q_oproducts o USING (offer_id)
 WHERE l.flag_top = 0"""
    taken = "SELECT NULL::BIGINT AS seller_id, NULL::VARCHAR AS offer_id, NULL::DOUBLE AS probability, 0 AS rank WHERE false"
    CTES[f"q_forced0{tag}"] = taken
    for i in (1, 2):
        CTES[f"q_forced{i}{tag}"] = f"""
SELECT * FROM q_forced{i - 1}{tag} UNION ALL SELECT seller_id, offer_id, probability, {i} FROM (
  SELECT *, {_RANK.format('')} AS n FROM (SELECT DISTINCT p.seller_id, p.offer_id, p.probability FROM q_prop{tag} p
   JOIN v_forced f ON f.forced_kind = 1 AND f.slot = {i} AND f.brand = p.brand AND f.category = p.category
   ANTI JOIN q_forced{i - 1}{tag} t ON t.seller_id = p.seller_id AND t.offer_id = p.offer_id)) WHERE n = 1"""
    CTES[f"q_cap{tag}"] = f"""
SELECT s.seller_id, (SELECT fixed_slots + free_slots FROM q_plan) - count(f.offer_id) AS capacity
 FROM (SELECT DISTINCT seller_id FROM q_prop{tag}) s LEFT JOIN q_forced2{tag} f USING (seller_id) GROUP BY 1"""
    CTES[f"q_open0{tag}"] = f"""
SELECT p.* FROM q_prop{tag} p ANTI JOIN q_forced2{tag} t ON t.seller_id = p.seller_id AND t.offer_id = p.offer_id
 WHERE NOT EXISTS (SELECT 1 FROM v_forced f WHERE f.forced_kind = 0 AND f.brand = p.brand AND f.category = p.category)"""
    picks = []
    for i in range(1, 9):
        CTES[f"q_pick{i}{tag}"] = f"""
SELECT seller_id, offer_id, probability, {i} AS rank FROM (SELECT *, {_RANK.format('')} AS n
  FROM (SELECT DISTINCT seller_id, offer_id, probability FROM q_open{i - 1}{tag})) JOIN q_cap{tag} USING (seller_id)
 WHERE n = 1 AND capacity >= {i}"""
        CTES[f"q_open{i}{tag}"] = f"""
SELECT o.* FROM q_open{i - 1}{tag} o WHERE NOT EXISTS (SELECT 1 FROM q_open{i - 1}{tag} x JOIN q_open{i - 1}{tag} y
  ON y.seller_id = x.seller_id AND y.product_id = x.product_id JOIN q_pick{i}{tag} k ON k.seller_id = y.seller_id AND k.offer_id = y.offer_id
  WHERE x.seller_id = o.seller_id AND x.offer_id = o.offer_id)"""
        picks.append(f"SELECT * FROM q_pick{i}{tag}")
    CTES[f"q_free{tag}"] = " UNION ALL ".join(picks)
    CTES[f"q_final{tag}"] = f"""
SELECT *, {_RANK.format('priority, ')} AS "order" FROM (
 SELECT seller_id, offer_id, probability, 'T' AS type, 1 AS priority FROM q_top{tag}
 UNION ALL SELECT seller_id, offer_id, probability, 'N', 2 FROM q_free{tag}
 UNION ALL SELECT seller_id, offer_id, probability, 'F', 3 FROM q_forced2{tag})"""


_ranking("", "SELECT DISTINCT seller_id, offer_id, flag_top, score_units AS probability FROM q_scored WHERE score_units <> 0", True)
_ranking("_m", "SELECT DISTINCT seller_id, offer_id, flag_top, score_mc_units AS probability FROM q_scored WHERE score_mc_units <> 0", True)
_ranking("_n", "SELECT seller_id, offer_id, max(flag_top) AS flag_top, max(probability) AS probability FROM q_nprob WHERE probability <> 0 GROUP BY 1,2", False)
FINAL["candidates"] = "SELECT * FROM q_cand"
FINAL["offer_rank"] = "SELECT * FROM q_rank"
FINAL["final_offers"] = """
SELECT seller_id, offer_id, probability, position AS "order", CASE position WHEN 3 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS interface_order
 FROM q_rank WHERE position <= 3"""
FINAL["top_slots"] = "SELECT * FROM q_top"
FINAL["proposals"] = "SELECT * FROM q_prop"
FINAL["forced_slots"] = "SELECT * FROM q_forced2"
FINAL["free_slots"] = "SELECT * FROM q_free"
FINAL["final_order"] = "SELECT * FROM q_final"
FINAL["final_order_engine"] = "SELECT * FROM q_final_m"
FINAL["final_order_new"] = "SELECT * FROM q_final_n"
CTES["q_per_offer"] = "SELECT offer_id, count(DISTINCT seller_id) AS total_sellers FROM q_final GROUP BY 1"
FINAL["sellers_per_offer"] = "SELECT * FROM q_per_offer"
FINAL["estimated_totals"] = """
WITH t AS (SELECT r.product_id, r.offer_type, r.offer_id, r.sales_code, r.units, r.price, r.parent, max(p.descr) AS descr, max(p.brand) AS brand,
  max(p.category) AS category, max(p.solo_type) AS solo_type FROM (SELECT DISTINCT offer_type, offer_id, product_id, units, price, sales_code, parent FROM v_estimation
    WHERE kind = 'E' AND personalisation = 'SR' AND process_cycle = '200110' AND target_cycle = '200111') r
  JOIN v_product p USING (product_id) WHERE p.descr IS NOT NULL GROUP BY 1,2,3,4,5,6,7)
SELECT t.offer_type, t.offer_id, t.brand, t.category, t.solo_type, t.product_id, t.descr, t.units, sum(c.total_sellers) AS total_sellers, 'SR' AS personalisation
 FROM q_per_offer c JOIN t USING (offer_id) GROUP BY 1,2,3,4,5,6,7,8"""

# ---- daily offer ---------------------------------------------------------------
CTES["q_daily"] = f"""
SELECT seller_id, offer_id, probability, row_number() OVER (PARTITION BY seller_id ORDER BY probability, offer_id) AS "order" FROM (
 SELECT *, {_RANK.format('')} AS n FROM (SELECT DISTINCT seller_id, offer_id, flag_top, score_units AS probability FROM q_scored)) WHERE n <= 6"""
CTES["q_daily_n"] = f"""
SELECT * FROM (SELECT *, {_RANK.format('')} AS "order" FROM (SELECT seller_id, offer_id, max(probability) AS probability FROM q_nprob GROUP BY 1,2))
 WHERE "order" <= 6"""
CTES["q_generic"] = """
SELECT 'XXXXXXXXX' AS seller_id, offer_id, probability, row_number() OVER (ORDER BY probability, offer_id) AS "order" FROM (
 SELECT offer_id, max(purchase_probability) AS probability FROM q_comp GROUP BY 1)"""
FINAL["daily_established"] = "SELECT * FROM q_daily"
FINAL["daily_new"] = "SELECT * FROM q_daily_n"
FINAL["daily_complement"] = "SELECT * FROM q_generic"


def _interface(rows: str, coded: str, kind: str, sale_cycle: str, configured: bool) -> str:
    if configured:
        join, day, order = "JOIN v_start_day d ON d.\"order\" = r.\"order\" AND d.state = 1", "d.start_day", "d.order_in_day"
    else:
        join, order = "", 'r."order"' if kind == "E" else "0"
        day = "CASE r.\"order\" WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN 4 END"
    return f"""
SELECT DISTINCT 'C1' AS country, 'ODD' AS personalisation, '{sale_cycle}' AS sale_cycle, r.seller_id, o.product_id, o.item_code, o.sales_code,
 'IDP' AS portal_zone, {day} AS start_day, 0 AS end_day, {order} AS "order", 0 AS flag_manual, '{kind}' AS kind, 0 AS link,
 0.0 AS price_per_unit, o.limit_units, o.flag_last_minute, 'X' AS profile FROM ({rows}) r JOIN {coded} o ON o.offer_id = r.offer_id AND o.parent = 1 {join}"""


_ROWS_E = 'SELECT CAST(seller_id AS VARCHAR) AS seller_id, offer_id, "order" FROM q_daily'
_ROWS_N = ('SELECT CAST(seller_id AS VARCHAR) AS seller_id, offer_id, "order" FROM q_daily_n'
           ' UNION ALL SELECT seller_id, offer_id, "order" FROM q_generic')
FINAL["daily_interface_configured"] = _interface(_ROWS_E, "q_coded", "E", "200111", True)
FINAL["daily_interface_default"] = _interface(_ROWS_E, "q_coded", "E", "200111", False)
FINAL["daily_interface_new_configured"] = _interface(_ROWS_N, "q_coded_n", "N", "199613", True)
FINAL["daily_interface_new"] = _interface(_ROWS_N, "q_coded_n", "N", "199613", False)


# ---- stored tables -------------------------------------------------------------
CTES["q_cycle_totals"] = "SELECT cycle, seller_id, sum(net) AS net FROM v_sales WHERE cycle BETWEEN 36010 AND 36027 GROUP BY 1, 2"
FINAL["io_parameter_csv"] = "SELECT * FROM v_parameters"
FINAL["io_source_table"] = "SELECT * FROM v_seller WHERE seller_id % 3 <> 0"
FINAL["io_full_overwrite"] = f"SELECT * FROM v_seller WHERE enrol_cycle > {PN}"
FINAL["io_partition_overwrite"] = f"SELECT seller_id, cycle, CASE WHEN cycle = {P} THEN 2 * net ELSE net END AS net FROM q_cycle_totals"
FINAL["io_run_log"] = f"""
SELECT r.run_id, 'status' AS step, 'C1' AS country, '200110' AS process_cycle, '200111' AS target_cycle, 'E' AS kind, r.message, 1 AS status FROM (
 SELECT 'run-1' AS run_id, {text('cycle')} || ': ' || CAST(sum(flag_order) AS BIGINT) || ' sellers with orders' AS message FROM v_status WHERE cycle BETWEEN {R6} AND {P} GROUP BY cycle
 UNION ALL SELECT 'run-2', 'another run') r"""
FINAL["io_optional_table"] = """
SELECT 'drifted' AS state, seller_id, enrol_cycle, NULL AS profile FROM v_seller
UNION ALL SELECT 'whole', s.seller_id, s.enrol_cycle, p.profile FROM v_seller s LEFT JOIN v_profile p ON p.seller_id = s.seller_id"""
FINAL["warehouse_sales"] = f"SELECT * FROM v_sales WHERE cycle BETWEEN {S} AND {P}"
FINAL["warehouse_status"] = f"SELECT * FROM v_status WHERE cycle BETWEEN {R6} AND {P}"
FINAL["warehouse_catalog"] = "SELECT * FROM v_catalog"
FINAL["warehouse_sellers"] = "SELECT * FROM v_seller"
FINAL["warehouse_products"] = "SELECT * FROM v_product"
FINAL["warehouse_geography"] = "SELECT * FROM v_geo"
FINAL["warehouse_base"] = "SELECT * FROM q_base"
FINAL["warehouse_final_order"] = "SELECT * FROM q_final"
FINAL["parameter_offers"] = "SELECT * FROM v_parameters"
FINAL["parameter_offers_estimation"] = "SELECT * FROM v_estimation"
FINAL["parameter_forced_slots"] = "SELECT * FROM v_slot_file"
FINAL["parameter_forced_slots_estimation"] = "SELECT * FROM v_slot_file WHERE personalisation = 'SR'"
FINAL["parameter_profiles"] = "SELECT * FROM v_profile"
_LINE = ("country || ',' || process_cycle || ',' || target_cycle || ',' || kind || ',' || personalisation || ',' || profile || ',' || offer_type || ',' || offer_id"
         " || ',' || {0} || ',' || {1} || ',' || price || ',' || sales_code || ',' || parent || ',' || flag_top || ',' || limit_units || ',' || flag_last_minute"
         " || ',' || link || ',' || slots || ',' || top_slots")
FINAL["parameter_rejected"] = f"""
SELECT 'offers' AS file, {_LINE.format('product_id', "'x' || units")} AS line, 'UNIDADES is not int' AS reason FROM v_parameters WHERE profile = '2'
UNION ALL SELECT 'offers', {_LINE.format("product_id || ',?'", 'units')}, 'wrong number of fields' FROM v_parameters WHERE kind = 'N' AND flag_top = 1"""
FINAL["io_self_overwrite"] = "SELECT seller_id, cycle, 2 * net AS net FROM q_cycle_totals"


# ---- composition ---------------------------------------------------------------
_NAME = re.compile(r"\b[qv]_\w+\b")


def _needed(sql: str, found: set[str]) -> set[str]:
    for name in _NAME.findall(sql):
        if name in CTES and name not in found:
            found.add(name)
            _needed(CTES[name], found)
    return found


def statement(name: str, columns: list[tuple[str, str]]) -> str:
    """The full statement of a query, columns cast as its spec says."""
    body = FINAL[name]
    needed = _needed(body, set())
    ctes = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in _ordered(needed)]

    def shape(col, kind):
        x = f'CAST("{col}" AS {SQL_TYPES[kind]})'
        return f'{rnd(x, 6) if kind == "r" else x} AS "{col}"'
    select = ", ".join(shape(c, k) for c, k in columns)
    head = f"WITH {', '.join(ctes)}\n" if ctes else ""
    return f"{head}SELECT {select} FROM ({body}) AS result"


def _ordered(names: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name):
        if name in done:
            return
        for child in _NAME.findall(CTES[name]):
            if child in CTES and child != name:
                visit(child)
        done.append(name)
    for n in CTES:
        if n in names:
            visit(n)
    return done


def all_statements(specs: dict[str, list[tuple[str, str]]]) -> dict[str, str]:
    return {name: statement(name, columns) for name, columns in specs.items() if name in FINAL}
