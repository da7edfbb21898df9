"""The same queries as DuckDB SQL, written from the semantics rather than from the Spark plans."""

from __future__ import annotations

from tidemark.plans.booking_view import COLUMNS, POD_COLUMNS
from tidemark.plans.drift import PRICING_BILLING, PRICING_TP, SUMMARY_BILLING
from workload.roles import AS_OF, LOOKBACK, PAYMENT_SHIFT, PLAIN_POD, drift_columns

NOW = "19980601000000"


def _duck(expression: str) -> str:
    """The booking columns' Spark expressions in DuckDB spelling."""
    return (
        expression.replace("date_add(DATE'1998-01-01', CAST(", "(DATE'1998-01-01' + CAST((")
        .replace(" AS INT))", ") AS INT))")
        .replace("CAST(p_partkey AS STRING)", "CAST(p_partkey AS VARCHAR)")
        .replace("1.5D", "1.5::DOUBLE")
        .replace("10.0D", "10.0::DOUBLE")
    )


def _pod() -> str:
    columns = []
    for i, c in enumerate(POD_COLUMNS):
        plain = _duck(PLAIN_POD[c]) if c in PLAIN_POD else f"concat('{c}-', p_partkey % {3 + i % 11})"
        columns.append(f"{plain} AS {c}")
    return "SELECT " + ", ".join(columns) + " FROM part"


def _drift(name: str) -> str:
    base = "SELECT * FROM part" + ("" if name == "summary_extract" else " WHERE p_partkey % 25 <> 3")
    rows = f"({base} UNION ALL SELECT * FROM ({base}) q WHERE p_partkey % 53 = 0)"
    columns = ", ".join(f"{e.replace('STRING', 'VARCHAR')} AS {c}" for c, e in drift_columns()[name].items())
    return f"SELECT {columns} FROM {rows} r"


ROLES = {
    "heads": """SELECT o_orderkey AS doc_entry, o_orderkey AS doc_num, CAST(o_orderdate AS DATE) AS create_date,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INT) AS update_date,
        CAST(o_orderkey * 7919 % 24 * 10000 + o_orderkey % 60 * 100 AS INT) AS update_ts,
        CASE WHEN o_orderstatus = 'P' THEN 'Y' WHEN o_orderkey % 11 = 0 THEN 'C' WHEN o_orderkey % 13 <> 0 THEN 'N' END AS cancelled,
        CASE WHEN o_orderkey % 5 = 0 THEN 'PV' || o_orderkey || ' , PV' || (o_orderkey + 1)
             WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 1009 = 0 THEN '' ELSE 'PV' || o_orderkey END AS pv_no
        FROM orders""",
    "lines": "SELECT l_orderkey AS doc_entry, CAST(l_partkey AS VARCHAR) AS item FROM lineitem",
    "payable": "SELECT * FROM heads WHERE doc_num % 3 <> 2",
    "sales": "SELECT * FROM heads WHERE doc_num % 3 <> 0",
    "receivable": "SELECT * FROM heads WHERE doc_num % 3 <> 1",
    "payable_line": "SELECT * FROM lines WHERE CAST(item AS BIGINT) % 5 <> 0",
    "receivable_line": """SELECT l_orderkey AS doc_entry, CAST(l_partkey AS VARCHAR) AS item FROM lineitem WHERE l_partkey % 7 <> 0
        UNION ALL SELECT l_orderkey, CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_partkey % 7 <> 0 AND l_linenumber = 1""",
    "pod": _pod(),
    "tp": """SELECT CAST(p_partkey AS VARCHAR) AS booking_id, 'T' || p_partkey AS code,
        CASE WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 17 = 0 THEN NULL
             WHEN p_partkey % 7 = 0 THEN 'PV' || (p_partkey * 7 + 1)
             WHEN p_partkey % 3 = 0 THEN array_to_string(many, ' , ') ELSE array_to_string(many, ', ') END AS pv_no
        FROM (SELECT *, list_transform(range(0, p_size % 5 + 1), lambda i: 'PV' || (p_partkey * 7 + i * 3)) AS many
              FROM part) p""",
    "billing": """SELECT CAST(p_partkey AS VARCHAR) AS booking_id, 'B' || p_partkey AS code,
        CASE WHEN p_partkey % 9 = 0 THEN 'n/a' ELSE CAST(p_partkey * 8 AS VARCHAR) END AS so_ref
        FROM (SELECT p_partkey FROM part WHERE p_partkey % 6 <> 0
              UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 6 <> 0 AND p_partkey % 101 = 0) b""",
    "pricing": """SELECT CAST(p_partkey AS VARCHAR) AS booking_id,
        CASE WHEN p_partkey % 9 <> 0 THEN 'R' || p_partkey END AS code, p_retailprice AS gross_rates,
        CASE WHEN p_partkey % 31 <> 0 THEN (p_partkey % 50)::DOUBLE END AS demurrage2,
        (p_partkey % 3)::DOUBLE * 10 AS addtl_drop, (p_partkey % 5)::DOUBLE * 2.5 AS boom_truck,
        (p_partkey % 7)::DOUBLE * 4 AS manpower, p_size::DOUBLE AS backload FROM part WHERE p_partkey % 8 <> 0""",
    "partner": """SELECT 'C' || c_custkey AS code, c_name AS name, CAST(c_custkey % 15 AS INT) AS cdc,
        CASE WHEN c_custkey % 12 <> 0 THEN CAST(c_custkey % 7 AS INT) END AS dcd, c_mktsegment AS group_location,
        CAST(NULL AS VARCHAR) AS vat_status FROM customer
        UNION ALL SELECT 'S' || s_suppkey, s_name, NULL, NULL, NULL,
        CASE s_suppkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN 'X' END FROM supplier""",
    "items": """SELECT CASE WHEN p_partkey % 50 <> 7 THEN CAST(p_partkey AS VARCHAR) END AS item,
        DATE'1998-04-01' + CAST(p_partkey % 100 AS INT) AS create_date,
        CAST(p_partkey * 7919 % 24 * 10000 + p_partkey % 60 * 100 AS INT) AS create_ts FROM part""",
    "payment_head": f"""SELECT event_id AS doc_entry, event_id AS doc_num,
        CAST(ts AS DATE) - {PAYMENT_SHIFT} AS create_date,
        CAST(ts AS DATE) - {PAYMENT_SHIFT} + CAST(event_id % 2 AS INT) AS update_date,
        CAST(hour(ts) * 10000 + minute(ts) * 100 AS INT) AS update_ts,
        CASE WHEN event_id % 9 = 0 THEN 'Y' WHEN event_id % 7 = 0 THEN 'C' WHEN event_id % 10 <> 0 THEN 'N' END AS cancelled
        FROM events WHERE event_type = 'purchase'""",
    "payment_line": """SELECT event_id AS doc_num, event_id AS doc_entry FROM events WHERE event_type = 'purchase'
        UNION ALL SELECT event_id, event_id + 7 FROM events WHERE event_type = 'purchase'""",
    "live": "SELECT item, doc_num FROM heads JOIN lines USING (doc_entry) WHERE cancelled = 'N'",
    "lists": """SELECT item, substr(' ' || string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num), 1, 1000) AS doc_list
        FROM live GROUP BY item""",
    "dlists": """SELECT item, substr(' ' || string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num), 1, 1000) AS doc_list
        FROM (SELECT DISTINCT item, doc_num FROM live) d GROUP BY item""",
    "rlive": "SELECT item, doc_num FROM receivable JOIN receivable_line USING (doc_entry) WHERE cancelled = 'N'",
    "rlists": """SELECT item, substr(' ' || string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num), 1, 1000) AS doc_list
        FROM rlive GROUP BY item""",
    "rdlists": """SELECT item, substr(' ' || string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num), 1, 1000) AS doc_list
        FROM (SELECT DISTINCT item, doc_num FROM rlive) d GROUP BY item""",
    "plive": "SELECT item FROM payable JOIN payable_line USING (doc_entry) WHERE cancelled = 'N'",
    "read_model": """SELECT CAST(p_partkey AS VARCHAR) AS booking_id,
        CASE WHEN p_partkey % 19 = 0 THEN 'n/a' ELSE CAST(p_partkey * 7 AS VARCHAR) END AS so_ref,
        array_to_string(list_transform(range(0, p_size % 4 + 1), lambda i: CAST(p_partkey * 5 + i * 11 AS VARCHAR)), ', ')
            AS doc_refs,
        CASE WHEN p_partkey % 2 = 0 THEN (p_partkey * 5 + 1) || ' ,n/a' END AS paid_refs,
        CASE WHEN p_partkey % 25 = 4 THEN array_to_string(list_reverse(string_split(trim(doc_list), ', ')), ', ')
            WHEN p_partkey % 25 = 6 THEN regexp_replace(trim(doc_list), '^[0-9]+', '7')
            WHEN p_partkey % 5 = 1 THEN NULL WHEN p_partkey % 5 = 2 THEN ' ' WHEN p_partkey % 5 = 3 THEN doc_list
            ELSE (p_partkey * 3) || ', ' || (p_partkey * 3 + 1) END AS ar_refs,
        CASE WHEN p_partkey % 11 = 0 THEN ' ' WHEN p_partkey % 22 = 1 THEN NULL ELSE p_brand END AS ptf_no
        FROM (SELECT * FROM part WHERE p_partkey % 10 <> 0
              UNION ALL SELECT * FROM part WHERE p_partkey % 10 <> 0 AND p_partkey % 97 = 0) p
        LEFT JOIN rdlists ON item = CAST(p_partkey AS VARCHAR)""",
    "rates_staging": """SELECT CAST(p_partkey AS VARCHAR) AS booking_id,
        CASE WHEN p_partkey % 5 = 0 THEN 'NaN' ELSE CAST(p_size AS VARCHAR) END AS amount,
        CASE WHEN p_partkey % 7 = 0 THEN 'NaN' WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS addl_amount FROM part""",
    "summary_extract": _drift("summary_extract"),
    "billing_extract": _drift("billing_extract"),
    "pricing_extract": _drift("pricing_extract"),
    "tp_extract": _drift("tp_extract"),
    "changed": f"""SELECT *, strftime(update_date, '%Y%m%d') || update_ts AS moment FROM heads
        WHERE (create_date BETWEEN DATE'{AS_OF}' - {LOOKBACK} AND DATE'{AS_OF}')
           OR (update_date BETWEEN DATE'{AS_OF}' - {LOOKBACK} AND DATE'{AS_OF}')""",
    "ap": """SELECT DISTINCT t.booking_id AS id, 'AP' || h.doc_num || '-' || h.moment AS serial
        FROM (SELECT * FROM changed WHERE doc_num % 3 <> 2) h LEFT JOIN payable_line l ON l.doc_entry = h.doc_entry
        JOIN tp t ON rtrim(t.pv_no) = rtrim(h.pv_no)
          OR list_contains(list_transform(string_split(t.pv_no, ','), lambda x: trim(x)), rtrim(h.pv_no))
          OR list_contains(list_transform(string_split(h.pv_no, ','), lambda x: trim(x)), rtrim(t.pv_no))
          OR t.booking_id = l.item""",
    "named_by": """SELECT DISTINCT t.booking_id, h.doc_num FROM payable h LEFT JOIN payable_line l ON l.doc_entry = h.doc_entry
        JOIN tp t ON (rtrim(t.pv_no) = rtrim(h.pv_no) AND trim(h.pv_no) <> '')
          OR (trim(h.pv_no) <> '' AND list_contains(list_transform(string_split(t.pv_no, ','), lambda x: trim(x)), rtrim(h.pv_no)))
          OR (trim(t.pv_no) <> '' AND list_contains(list_transform(string_split(h.pv_no, ','), lambda x: trim(x)), rtrim(t.pv_no)))
          OR t.booking_id = l.item""",
    "op": f"""SELECT DISTINCT m.booking_id AS id, 'OP' || p.doc_num || '-' || strftime(p.update_date, '%Y%m%d') || p.update_ts AS serial
        FROM payment_head p JOIN payment_line pl ON pl.doc_num = p.doc_entry JOIN payable h ON h.doc_entry = pl.doc_entry
        JOIN (SELECT booking_id, TRY_CAST(trim(unnest(string_split(doc_refs, ','))) AS BIGINT) AS ref FROM read_model
              UNION ALL SELECT booking_id, TRY_CAST(trim(unnest(string_split(paid_refs, ','))) AS BIGINT) FROM read_model) m
          ON m.ref = h.doc_num
        WHERE p.cancelled <> 'Y' AND ((p.create_date BETWEEN DATE'{AS_OF}' - {LOOKBACK} AND DATE'{AS_OF}')
           OR (p.update_date BETWEEN DATE'{AS_OF}' - {LOOKBACK} AND DATE'{AS_OF}'))""",
    "so": """SELECT l.item AS id, 'SO' || doc_num || '-' || moment AS serial FROM changed JOIN lines l USING (doc_entry)
        WHERE doc_num % 3 <> 0 UNION SELECT m.booking_id, 'SO' || doc_num || '-' || moment FROM changed
        JOIN read_model m ON TRY_CAST(m.so_ref AS BIGINT) = doc_num WHERE doc_num % 3 <> 0""",
    "ar": """SELECT DISTINCT l.item AS id, 'AR' || doc_num || '-' || moment AS serial
        FROM changed JOIN receivable_line l USING (doc_entry) WHERE doc_num % 3 <> 1""",
    "whole_so": """SELECT l.item AS id, 'SO' || doc_num || '-' || moment AS serial FROM changed JOIN lines l USING (doc_entry)
        UNION SELECT m.booking_id, 'SO' || doc_num || '-' || moment FROM changed
        JOIN read_model m ON TRY_CAST(m.so_ref AS BIGINT) = doc_num""",
    "whole_ar": """SELECT DISTINCT l.item AS id, 'AR' || doc_num || '-' || moment AS serial
        FROM changed JOIN lines l USING (doc_entry)""",
    "counts": "SELECT item, count(doc_num) AS n_docs, count(DISTINCT doc_num) AS n_distinct FROM live GROUP BY item",
    "rcounts": "SELECT item, count(doc_num) AS n_docs, count(DISTINCT doc_num) AS n_distinct FROM rlive GROUP BY item",
    "sets": """SELECT m.booking_id, m.ar_refs,
          list_sort(list_distinct(list_transform(string_split(m.ar_refs, ','), lambda x: trim(x)))) AS listed,
          (SELECT list_sort(list(DISTINCT CAST(doc_num AS VARCHAR))) FROM rlive WHERE item = m.booking_id) AS actual
        FROM (SELECT DISTINCT booking_id, ar_refs FROM read_model) m""",
    "bn": f"""SELECT DISTINCT item AS id, 'BN-' || strftime(create_date, '%Y%m%d') || create_ts AS serial FROM items i
        WHERE item IS NOT NULL AND create_date BETWEEN DATE'{AS_OF}' - {LOOKBACK} AND DATE'{AS_OF}'
          AND (EXISTS (SELECT 1 FROM pod WHERE booking_id = i.item) OR EXISTS (SELECT 1 FROM pricing WHERE booking_id = i.item))
          AND NOT EXISTS (SELECT 1 FROM read_model WHERE booking_id = i.item)""",
    "dup": f"SELECT booking_id AS id, 'DUP-{NOW}' AS serial FROM read_model GROUP BY booking_id HAVING count(*) > 1",
    "ptf": f"""SELECT DISTINCT booking_id AS id, 'PTF-{NOW}' AS serial FROM pod WHERE coalesce(trim(ptf_no), '') <> ''
        AND booking_id IN (SELECT booking_id FROM read_model WHERE booking_id IS NOT NULL AND coalesce(trim(ptf_no), '') = '')""",
    "missing": f"""SELECT DISTINCT booking_id AS id, 'MISSING-{NOW}' AS serial FROM pod
        WHERE booking_id NOT IN (SELECT booking_id FROM read_model)""",
    "arnr": f"""SELECT DISTINCT s.booking_id AS id, 'AR' || doc_list || '-NR-{NOW}' AS serial
        FROM sets s JOIN rcounts c ON c.item = s.booking_id JOIN rlists l ON l.item = s.booking_id
        WHERE coalesce(trim(ar_refs), '') = '' OR (len(string_split(ar_refs, ',')) < n_docs AND listed <> actual)""",
    "raw": """SELECT id, serial, 'AP' AS detector, 1 AS rank FROM ap UNION ALL SELECT *, 'OP', 2 FROM op
        UNION ALL SELECT *, 'SO', 3 FROM so UNION ALL SELECT *, 'AR', 4 FROM ar UNION ALL SELECT *, 'ARNR', 5 FROM arnr
        UNION ALL SELECT *, 'BN', 6 FROM bn UNION ALL SELECT *, 'DUP', 7 FROM dup UNION ALL SELECT *, 'PTF', 8 FROM ptf
        UNION ALL SELECT *, 'MISSING', 9 FROM missing""",
    "stamped": """SELECT *, CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) AS stamp
        FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM raw WHERE id IS NOT NULL) q""",
    "ledger": """SELECT DISTINCT item AS id,
        'AR' || doc_num || '-' || strftime(update_date, '%Y%m%d') || update_ts AS serial
        FROM heads JOIN lines USING (doc_entry) WHERE CAST(item AS BIGINT) % 3 = 0
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), unnest(['MISSING-19980601000000', 'PTF-19980601000000'])
        FROM part WHERE p_partkey % 4 = 0""",
    "newest": """SELECT id, serial, detector, stamp FROM stamped
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY stamp DESC, rank, serial) = 1""",
    "ar_stamped": """SELECT *, CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) AS stamp
        FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM ar) q""",
    "ar_steps": """SELECT *, row_number() OVER (ORDER BY stamp DESC, serial, id) AS step, count(*) OVER () AS n
        FROM ar_stamped""",
    "whole_ar_stamped": """SELECT *, CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) AS stamp
        FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM whole_ar) q""",
    "whole_ar_steps": """SELECT *, row_number() OVER (ORDER BY stamp DESC, serial, id) AS step, count(*) OVER () AS n
        FROM whole_ar_stamped""",
    "msg": """SELECT event_id, user_id, event_type, CAST(user_id AS VARCHAR) AS client, 'u' || user_id AS user_name,
        's' || user_id AS session_id, CAST(json_extract(props, '$.k') AS INT) AS k,
        ['pod', 'billing', 'tp', 'pricing'][CAST(json_extract(props, '$.k') AS INT) % 4 + 1] AS grp FROM events""",
    "junk": """SELECT event_id, ['', '[]', '{}', 'null', '"text"', '12', '{"type":', '[{"type":"MESSAGE"}]',
        '{"type":"MESSAGE"}', '{"a":1} x'][event_id % 10 + 1] AS text FROM events WHERE event_type = 'error'""",
    "valid": """SELECT event_id, session_id, CASE event_type WHEN 'purchase' THEN 'BROADCAST' ELSE 'MESSAGE' END AS type,
          CASE event_type WHEN 'view' THEN 'REGISTRATION' WHEN 'signup' THEN 'CLEAN_UP' WHEN 'click' THEN 'ASK_TO_UNLOCK'
               ELSE 'UPDATE' END AS event, client, CASE WHEN event_type <> 'signup' THEN grp END AS grp, k,
          CASE event_type WHEN 'view' THEN 'register' WHEN 'signup' THEN 'clean_up' WHEN 'click' THEN 'ask_to_unlock'
               ELSE 'update' END AS route FROM msg WHERE event_type <> 'error'
        UNION ALL SELECT event_id, NULL, CASE WHEN text LIKE '{%' THEN 'MESSAGE' END, NULL, NULL, NULL, NULL, NULL
        FROM junk WHERE event_id % 10 IN (7, 8)""",
    "stints": """SELECT grp, CAST(k AS VARCHAR) AS row_id, client, min(event_id) AS enter, leave FROM (
          SELECT v.*, (SELECT min(c.event_id) FROM msg c WHERE c.event_type = 'signup' AND c.client = v.client
                       AND c.event_id > v.event_id) AS leave FROM msg v WHERE event_type = 'view') q
        GROUP BY grp, k, client, leave""",
    "holds": """SELECT *, CASE WHEN turn < coalesce(leave, 9e18::BIGINT) THEN turn END AS granted FROM (
          SELECT *, greatest(enter, coalesce(max(coalesce(leave, 9e18::BIGINT)) OVER (PARTITION BY grp, row_id ORDER BY enter
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), enter)) AS turn FROM stints) q""",
    "held": """SELECT m.event_id, m.event_type, m.client, m.user_name, m.session_id, m.grp, CAST(m.k AS VARCHAR) AS row_id,
          h.client AS holder FROM msg m LEFT JOIN holds h ON h.grp = m.grp AND h.row_id = CAST(m.k AS VARCHAR)
            AND h.granted < m.event_id AND m.event_id < coalesce(h.leave, 9e18::BIGINT)
        WHERE m.event_type IN ('view', 'click')""",
    "told": """SELECT DISTINCT m.event_id, m.client AS sender, w.client AS recipient, m.grp, m.k, m.session_id
        FROM msg m JOIN holds w ON w.grp = m.grp AND w.row_id = CAST(m.k AS VARCHAR) AND w.enter < m.event_id
          AND (w.granted IS NULL OR w.granted <> w.enter)
          AND m.event_id < coalesce(w.granted, w.leave, 9e18::BIGINT)
        WHERE m.event_type = 'purchase' AND m.client <> w.client""",
    "sent": """SELECT event_id, 'REPLY' AS kind, client AS recipient, session_id, 'REGISTRATION' AS event,
          CAST(NULL AS VARCHAR) AS status, grp, CASE WHEN holder IS NULL THEN '' ELSE row_id END AS ids
        FROM held WHERE event_type = 'view'
        UNION ALL SELECT granted, 'DIRECT', client, '', 'RELEASE', NULL, grp, row_id FROM holds WHERE granted <> enter
        UNION ALL SELECT event_id, 'DIRECT', coalesce(holder, client), CASE WHEN holder IS NULL THEN session_id ELSE '' END,
          'ASK_TO_UNLOCK', CASE WHEN holder IS NULL THEN 'FAILED' ELSE 'REQUEST' END, grp, row_id
        FROM held WHERE event_type = 'click'
        UNION ALL SELECT event_id, 'BROADCAST', recipient, session_id, 'UPDATE', NULL, grp, CAST(k AS VARCHAR) FROM told""",
    "live_ref": "SELECT DISTINCT CAST(doc_entry AS VARCHAR) AS ref FROM heads WHERE cancelled = 'N'",
    "order_ref": "SELECT DISTINCT CAST(doc_entry AS VARCHAR) AS ref FROM sales WHERE cancelled = 'N'",
    "in_cell": """SELECT DISTINCT c.pv_no FROM (SELECT DISTINCT pv_no FROM tp WHERE pv_no IS NOT NULL) c
        JOIN (SELECT DISTINCT trim(pv_no) AS needle FROM payable WHERE cancelled = 'N' AND trim(pv_no) <> '') n
          ON contains(translate(trim(c.pv_no), ' ,', ''), n.needle)""",
    "in_tokens": """SELECT DISTINCT t.pv_no
        FROM (SELECT pv_no, unnest(list_transform(string_split(pv_no, ','), lambda x: trim(x))) AS tok FROM tp) t
        JOIN (SELECT trim(pv_no) AS needle FROM payable WHERE cancelled = 'N') n ON n.needle = t.tok WHERE t.tok <> ''""",
    "disabled": """SELECT booking_id, CASE WHEN booking_id IN (SELECT item FROM rlive)
          AND (booking_id IN (SELECT item FROM plive) OR pv_no IN (SELECT pv_no FROM in_cell)) THEN 'Y' ELSE 'N' END AS disable_row
        FROM tp""",
}


def _metrics() -> dict[str, str]:
    late = "CAST(CASE WHEN deadline IS NOT NULL THEN deadline + coalesce(holiday_days, 0) - CASE WHEN actual_received IS NULL"
    late += f" OR actual_received = DATE'1900-01-01' THEN DATE'{AS_OF}' ELSE actual_received END ELSE 0 END AS INT)"
    star = """SELECT p.*, b.code AS b_code, b.so_ref AS b_ref, t.code AS t_code, t.pv_no, r.code AS r_code, r.gross_rates,
          r.demurrage2, r.addtl_drop + r.boom_truck + r.manpower + r.backload AS extras, c.name AS c_name,
          coalesce(c.cdc, 0) AS cdc, coalesce(c.dcd, 0) AS dcd, c.group_location, k.name AS k_name,
          coalesce(k.vat_status, 'Y') AS vat
        FROM pod p LEFT JOIN billing b USING (booking_id) LEFT JOIN tp t USING (booking_id)
          LEFT JOIN pricing r USING (booking_id) LEFT JOIN partner c ON c.code = p.client_code
          LEFT JOIN partner k ON k.code = p.carrier_code"""
    net = lambda x: f"(CASE vat WHEN 'Y' THEN {x} WHEN 'N' THEN {x} / 1.12::DOUBLE END)"
    blank = lambda d: f"({d} IS NULL OR {d} = DATE'1900-01-01')"
    first = f"""SELECT *, {net('gross_rates')} + {net('demurrage2')} + {net('extras')} AS carrier_total,
          CASE WHEN {blank('client_received')} THEN 'PENDING' ELSE 'SUBMITTED' END AS client_sub_status,
          CAST(CASE WHEN NOT {blank('client_received')} AND NOT {blank('delivery_date')}
               THEN (delivery_date - client_received) + dcd + coalesce(waived_days, 0) ELSE 0 END AS INT) AS client_sub_overdue,
          CASE WHEN NOT {blank('delivery_date')} THEN delivery_date + cdc END AS deadline FROM star"""
    second = f"""SELECT *, CASE WHEN client_sub_overdue < 0 THEN client_sub_overdue * 200 ELSE 0 END AS client_penalty,
          {late} AS overdue_days FROM m1"""
    third = """SELECT *, CASE WHEN deadline IS NULL THEN '' WHEN overdue_days >= 0 THEN 'Ontime'
          WHEN overdue_days BETWEEN -13 AND -1 THEN 'Late' ELSE 'Lost' END AS payment_status FROM m2"""
    fourth = """SELECT *, CASE WHEN payment_status = 'Late' THEN overdue_days * 200 ELSE 0 END AS carrier_penalty,
          CASE WHEN payment_status = 'Lost' AND coalesce(carrier_total, 0) <> 0 THEN -(carrier_total * 2)
               ELSE 0::DOUBLE END AS lost_penalty FROM m3"""
    fifth = """SELECT *, client_penalty + carrier_penalty + lost_penalty + coalesce(penalties_manual, 0) AS total_sub_penalties
        FROM m4"""
    sixth = "SELECT *, total_sub_penalties * coalesce(perc_penalty, 0) AS total_penalty_waived FROM m5"
    return {"star": star, "m1": first, "m2": second, "m3": third, "m4": fourth, "m5": fifth, "m6": sixth}


ROLES |= _metrics()

_DATES = ("booking_date", "delivery_date", "client_received", "initial_received", "actual_received")
_VIEW = {
    "disable_row": "CASE WHEN booking_id IN (SELECT item FROM rlive) AND (booking_id IN (SELECT item FROM plive) "
    "OR pv_no IN (SELECT pv_no FROM in_cell)) THEN 'Y' ELSE 'N' END",
    "code": "booking_id",
    "so_ref": "CASE WHEN b_ref IN (SELECT ref FROM order_ref) THEN b_ref ELSE '' END",
    "client_name": "c_name",
    "carrier_name": "k_name",
    "day_of_week": "CASE WHEN coalesce(trim(day_of_week), '') = '' THEN dayname(booking_date) ELSE day_of_week END",
    "waived": "CASE WHEN coalesce(trim(waived), '') = '' THEN 'N' ELSE waived END",
    "submit_deadline": "strftime(deadline, '%Y-%m-%d')",
    "billing_num": "coalesce(b_code, '')",
    "tp_num": "coalesce(t_code, '')",
    "pricing_num": "coalesce(r_code, '')",
    "gross_trucker_rates": "coalesce(gross_rates, 0::DOUBLE)",
    "group_project": "coalesce(group_location, '')",
} | {d: f"strftime({d}, '%Y-%m-%d')" for d in _DATES}


def _day(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d') AS {name}"


def _pairs_text() -> str:
    nospace = lambda c: f"replace({c}, ' ', '')"
    tests = []
    for a, b in SUMMARY_BILLING:
        x, y = f"s.{a}", f"b.{b}"
        tests.append(
            f"({x} <> {y} AND {nospace(x)} <> {nospace(y)}) OR (coalesce({nospace(x)}, '') <> '' AND coalesce({nospace(y)}, '') = '')"
            f" OR (coalesce({nospace(y)}, '') <> '' AND coalesce({nospace(x)}, '') = '')"
        )
    return " OR ".join(tests)


def _pairs_number(pairs: list[tuple[str, str]]) -> str:
    value = lambda c: f"(CASE WHEN {c} <> 'NaN' THEN TRY_CAST(replace({c}, ',', '') AS DOUBLE) END)"
    tests = []
    for a, b in pairs:
        x, y = value(f"p.{a}"), value(f"o.{b}")
        tests.append(f"{x} <> {y} OR ({x} IS NOT NULL AND {x} <> 0 AND ({y} IS NULL OR {y} = 0))")
    return " OR ".join(tests)


def _verified(prefix: str, tests: str, side: str, extract: str, known: str = "WHERE booking_id IS NOT NULL") -> str:
    return f"""SELECT DISTINCT booking_id AS id, '{prefix}-{NOW}' AS serial FROM pod WHERE ({tests})
        AND booking_id NOT IN (SELECT booking_id FROM {extract} {known})
        AND booking_id IN (SELECT booking_id FROM {side} WHERE booking_id IS NOT NULL)"""


_MODEL = "booking_id, so_ref, doc_refs, paid_refs, ar_refs, ptf_no"
_FRESH = """SELECT p.booking_id, b.so_ref, NULL, NULL, NULL, p.ptf_no FROM pod p
    LEFT JOIN (SELECT DISTINCT booking_id, so_ref FROM billing) b USING (booking_id)"""
_EVENT = "id, serial"
_HOLD = "grp, row_id, client, enter AS enter_id, leave AS leave_id, granted AS granted_id"
_KEPT = "SELECT grp, row_id, client, enter AS enter_id FROM holds WHERE granted IS NOT NULL"
_PROCESSED = "NOT EXISTS (SELECT 1 FROM ledger l WHERE l.id = q.id AND l.serial = q.serial)"
_TOKENS = "list_transform(string_split(pv_no, ','), lambda x: trim(x))"

_BILLABLE = "status_detail LIKE '%Verified%' OR status_detail LIKE '%ForAdvanceBilling%'"
_ROWS = """SELECT p.booking_id, so_ref, doc_refs, paid_refs, ar_refs, ptf_no
    FROM (SELECT booking_id, max(ptf_no) AS ptf_no FROM pod WHERE booking_id IS NOT NULL GROUP BY booking_id) p
    LEFT JOIN (SELECT booking_id, max(so_ref) AS so_ref FROM billing GROUP BY booking_id) USING (booking_id)
    LEFT JOIN (SELECT item AS booking_id, string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num) AS ar_refs
               FROM (SELECT DISTINCT item, doc_num FROM rlive) GROUP BY item) USING (booking_id)
    LEFT JOIN (SELECT booking_id, string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num) AS doc_refs,
                 string_agg(CAST(doc_num AS VARCHAR), ', ' ORDER BY doc_num) FILTER (WHERE settled) AS paid_refs
               FROM (SELECT *, doc_num IN (SELECT h.doc_num FROM payment_head p JOIN payment_line pl ON pl.doc_num = p.doc_entry
                                           JOIN payable h ON h.doc_entry = pl.doc_entry WHERE p.cancelled <> 'Y') AS settled
                     FROM named_by) GROUP BY booking_id) USING (booking_id)"""

BODIES = {
    "model_rows": _ROWS,
    "refresh_converges": "SELECT id, serial FROM newest WHERE id LIKE '%5' AND id IN (SELECT booking_id FROM pod)",
    "refresh_with_scrub": """SELECT booking_id,
          CASE WHEN amount = 'NaN' AND booking_id IN (SELECT booking_id FROM pod WHERE status_detail = 'Verified') THEN NULL ELSE amount END AS amount,
          CASE WHEN addl_amount = 'NaN' AND booking_id IN (SELECT booking_id FROM pod WHERE status_detail = 'Verified') THEN NULL ELSE addl_amount END AS addl_amount
        FROM rates_staging""",
    "process_partial_failure": "SELECT DISTINCT booking_id FROM pod WHERE booking_id LIKE '%3' AND booking_id <> '13'",
    "event_file_array": "SELECT id, serial FROM ar",
    "lock_ids": """SELECT grp, row_id, client, granted AS granted_id, md5(concat_ws('|', grp, row_id, client, granted)) AS lock_id
        FROM holds WHERE granted IS NOT NULL""",
    "release_payloads": """SELECT granted AS event_id, client AS recipient,
          '{"sessionId":"","type":"MESSAGE","event":"RELEASE","data":{"prop":{"group":"' || grp || '","id":"' || row_id || '"}}}' AS payload
        FROM holds WHERE granted <> enter""",
    "read_table_source": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "event_file": f"SELECT {_EVENT} FROM whole_ar",
    "event_file_stream": f"SELECT {_EVENT} FROM ar",
    "incremental_poll": "SELECT event_id, event_type FROM events",
    "messages_valid": "SELECT event_id, session_id, type, event, client, grp FROM valid",
    "messages_rejected": "SELECT event_id, text FROM junk WHERE event_id % 10 NOT IN (7, 8)",
    "message_dispatch": "SELECT event_id, route FROM valid WHERE route IS NOT NULL",
    "message_requests": """SELECT event_id, route, client, grp, CASE WHEN route <> 'clean_up' THEN CAST(k AS VARCHAR) END AS ids
        FROM valid WHERE route IS NOT NULL""",
    "changed_on": f"SELECT doc_num, {_day('create_date')}, {_day('update_date')} FROM changed",
    "created_on": f"SELECT doc_num, {_day('create_date')} FROM heads WHERE create_date = DATE'{AS_OF}'",
    "blank_filter": "SELECT booking_id, ptf_no FROM read_model WHERE coalesce(trim(ptf_no), '') = ''",
    "not_null_keys": f"SELECT item, {_day('create_date')} FROM items WHERE item IS NOT NULL",
    "not_cancelled_is_n": "SELECT doc_num FROM payment_head WHERE cancelled = 'N'",
    "not_cancelled_not_y": "SELECT doc_num FROM payment_head WHERE cancelled <> 'Y'",
    "csv_membership": f"""SELECT booking_id, pv_no FROM tp
        WHERE list_contains({_TOKENS}, 'PV' || (CAST(booking_id AS BIGINT) * 7 + 3))""",
    "disjunctive_existence": """SELECT item FROM items i WHERE EXISTS (SELECT 1 FROM billing WHERE booking_id = i.item)
        OR EXISTS (SELECT 1 FROM pricing WHERE booking_id = i.item)""",
    "text_has": """SELECT booking_id FROM pod WHERE status_detail LIKE '%Verified%' OR status_detail LIKE '%ForAdvanceBilling%'""",
    "locks_kept": _KEPT + " AND NOT (client = '8' AND grp = 'pod')",
    "locks_removed": _KEPT + " AND client = '8'",
    "header_lines": "SELECT doc_num, item FROM heads JOIN lines USING (doc_entry)",
    "multivalue_join": f"""WITH h AS (SELECT doc_num, rtrim(pv_no) AS pv, unnest({_TOKENS}) AS tok FROM heads WHERE pv_no IS NOT NULL),
        r AS (SELECT booking_id, rtrim(pv_no) AS pv, unnest({_TOKENS}) AS tok FROM tp WHERE pv_no IS NOT NULL)
        SELECT r.booking_id AS id, CAST(h.doc_num AS VARCHAR) AS serial FROM h JOIN r ON r.pv = h.pv
        UNION SELECT r.booking_id, CAST(h.doc_num AS VARCHAR) FROM h JOIN r ON r.tok = h.pv
        UNION SELECT r.booking_id, CAST(h.doc_num AS VARCHAR) FROM h JOIN r ON r.pv = h.tok
        UNION SELECT t.booking_id, CAST(d.doc_num AS VARCHAR) FROM heads d JOIN lines l USING (doc_entry)
          JOIN tp t ON t.booking_id = l.item""",
    "csv_ref_join": """SELECT DISTINCT m.booking_id AS id, CAST(doc_num AS VARCHAR) AS serial FROM heads
        JOIN (SELECT booking_id, unnest(string_split(concat_ws(',', doc_refs, paid_refs), ',')) AS ref FROM read_model) m
          ON TRY_CAST(trim(m.ref) AS BIGINT) = doc_num""",
    "payment_to_invoice": """SELECT p.doc_num AS pay_num, h.doc_num FROM payment_head p
        JOIN payment_line pl ON pl.doc_num = p.doc_entry JOIN heads h ON h.doc_entry = pl.doc_entry""",
    "docnum_ref_join": """SELECT DISTINCT booking_id AS id, CAST(doc_num AS VARCHAR) AS serial FROM heads
        JOIN read_model ON TRY_CAST(so_ref AS BIGINT) = doc_num""",
    "semi_join_in": """SELECT booking_id FROM pod WHERE booking_id IN
        (SELECT booking_id FROM read_model WHERE coalesce(trim(ptf_no), '') = '')""",
    "semi_join_exists": "SELECT booking_id FROM pod p WHERE EXISTS (SELECT 1 FROM live WHERE item = p.booking_id)",
    "anti_join_not_exists": f"""SELECT item, {_day('create_date')} FROM items i
        WHERE NOT EXISTS (SELECT 1 FROM read_model WHERE booking_id = i.item)""",
    "not_in_keys": "SELECT booking_id FROM pod WHERE booking_id NOT IN (SELECT booking_id FROM read_model)",
    "not_in_null_keys": "SELECT booking_id FROM pod WHERE booking_id NOT IN (SELECT item FROM items)",
    "enrich_booking": """SELECT booking_id, b_code AS billing_code, t_code AS tp_code, r_code AS pricing_code,
        c_name AS client_name, k_name AS carrier_name FROM star""",
    "row_disabled_flag": "SELECT booking_id, disable_row FROM disabled",
    "row_disabled_flag_token": """SELECT booking_id, CASE WHEN booking_id IN (SELECT item FROM rlive)
          AND (booking_id IN (SELECT item FROM plive) OR pv_no IN (SELECT pv_no FROM in_tokens)) THEN 'Y' ELSE 'N' END AS disable_row
        FROM tp""",
    "contains_join": """SELECT DISTINCT c.pv_no FROM (SELECT DISTINCT pv_no FROM tp WHERE pv_no IS NOT NULL) c
        JOIN (SELECT DISTINCT trim(pv_no) AS needle FROM heads WHERE trim(pv_no) <> '') n
          ON contains(translate(trim(c.pv_no), ' ,', ''), n.needle)""",
    "token_hits": f"""SELECT DISTINCT t.pv_no FROM (SELECT pv_no, unnest({_TOKENS}) AS tok FROM tp) t
        JOIN heads h ON trim(h.pv_no) = t.tok WHERE t.tok <> ''""",
    "valid_ref_or_blank": """SELECT booking_id, CASE WHEN so_ref IN (SELECT ref FROM live_ref) THEN so_ref ELSE '' END AS so_ref
        FROM billing""",
    "exclude_processed": f"SELECT {_EVENT} FROM whole_ar q WHERE {_PROCESSED}",
    "registration_intervals": "SELECT grp, row_id, client, enter AS enter_id, leave AS leave_id FROM stints",
    "holder_at": "SELECT grp, row_id, event_id, holder FROM held WHERE event_type = 'view'",
    "duplicate_keys": "SELECT item, count(*) AS n_rows FROM items GROUP BY item HAVING count(*) > 1",
    "docs_per_item": "SELECT item, n_docs FROM counts",
    "docs_per_item_distinct": "SELECT item, n_distinct AS n_docs FROM counts",
    "doc_list": "SELECT item, doc_list FROM lists",
    "doc_list_distinct": "SELECT item, doc_list FROM dlists",
    "csv_size": "SELECT booking_id, CAST(coalesce(len(string_split(pv_no, ',')), 0) AS INT) AS n_tokens FROM tp",
    "select_distinct": "SELECT DISTINCT booking_id, so_ref FROM read_model",
    "run_metrics": f"""SELECT (SELECT count(*) FROM raw) AS found, (SELECT count(*) FROM raw WHERE id IS NULL) AS null_ids,
        (SELECT count(*) FROM newest) AS fetched, (SELECT count(*) FROM newest q WHERE {_PROCESSED}) AS to_process""",
    "latest_per_id": """SELECT id, serial FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM whole_so) q
        QUALIFY row_number() OVER (PARTITION BY id
          ORDER BY CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) DESC, serial) = 1""",
    "first_per_id": """SELECT CAST(user_id AS VARCHAR) AS id, event_type AS serial, event_id FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "union_distinct_paths": "SELECT DISTINCT id FROM whole_so",
    "union_detectors": """SELECT id, serial, detector, CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) AS stamp
        FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM raw WHERE detector IN ('SO', 'AR', 'BN', 'DUP')) q""",
    "order_by_stamp": "SELECT id, serial, stamp FROM whole_ar_stamped",
    "limit_events": "SELECT id, serial FROM ar_steps WHERE step <= 100",
    "pending_steps": """SELECT step, id, n - step + 1 AS pending, array_to_string(list(id) OVER (ORDER BY step
          ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), ',') AS pending_ids FROM whole_ar_steps
        UNION ALL SELECT count(*) + 1, NULL, 0, '' FROM whole_ar_steps""",
    "detect_ap": f"SELECT {_EVENT} FROM ap",
    "detect_op": f"SELECT {_EVENT} FROM op",
    "detect_so": f"SELECT {_EVENT} FROM whole_so",
    "detect_ar": f"SELECT {_EVENT} FROM ar",
    "detect_arnr": f"SELECT {_EVENT} FROM arnr",
    "detect_arnr_legacy": f"""SELECT DISTINCT m.booking_id AS id, 'AR' || l.doc_list || '-NR-{NOW}' AS serial
        FROM read_model m JOIN rcounts c ON c.item = m.booking_id JOIN rlists l ON l.item = m.booking_id
        JOIN rdlists d ON d.item = m.booking_id WHERE coalesce(trim(ar_refs), '') = ''
          OR (len(string_split(ar_refs, ',')) < n_docs AND d.doc_list <> rtrim(ar_refs))""",
    "detect_arnr_distinct": f"""SELECT DISTINCT s.booking_id AS id, 'AR' || doc_list || '-NR-{NOW}' AS serial
        FROM sets s JOIN rcounts c ON c.item = s.booking_id JOIN rlists l ON l.item = s.booking_id
        WHERE coalesce(trim(ar_refs), '') = '' OR (len(string_split(ar_refs, ',')) < n_distinct AND listed <> actual)""",
    "detect_bn": f"SELECT {_EVENT} FROM bn",
    "detect_dup": f"SELECT {_EVENT} FROM dup",
    "detect_ptf": f"SELECT {_EVENT} FROM ptf",
    "detect_missing": f"SELECT {_EVENT} FROM missing",
    "detect_levels": "SELECT id, serial, detector FROM raw WHERE detector IN ('DUP', 'PTF', 'MISSING')",
    "detect_sbdi": f"""SELECT DISTINCT s.booking_id AS id, 'SBDI-{NOW}' AS serial FROM summary_extract s
        JOIN billing_extract b ON b.booking_id = s.booking_id WHERE {_pairs_text()}""",
    "detect_bpdi": f"""SELECT DISTINCT o.booking_id AS id, 'B-BTPDI-{NOW}' AS serial FROM billing_extract o
        JOIN pricing_extract p ON p.booking_id = o.booking_id WHERE {_pairs_number(PRICING_BILLING)}""",
    "detect_tpdi": f"""SELECT DISTINCT o.booking_id AS id, 'T-BTPDI-{NOW}' AS serial FROM tp_extract o
        JOIN pricing_extract p ON p.booking_id = o.booking_id WHERE {_pairs_number(PRICING_TP)}""",
    "detect_bvnr": _verified("B-TBVNR", _BILLABLE, "billing", "billing_extract", ""),
    "detect_bvnr_clean_keys": _verified("B-TBVNR", _BILLABLE, "billing", "billing_extract"),
    "detect_tvnr": _verified("T-TBVNR", "status_detail LIKE '%Verified%'", "tp", "tp_extract"),
    "fetch_events": "SELECT id, serial, detector, stamp FROM newest",
    "refresh_on_change": "SELECT id, serial, detector, stamp FROM newest",
    "fetch_dedupe_then_exclude": f"SELECT id, serial, detector, stamp FROM newest q WHERE {_PROCESSED}",
    "fetch_exclude_then_dedupe": f"""SELECT id, serial, detector, stamp FROM stamped q WHERE {_PROCESSED}
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY stamp DESC, rank, serial) = 1""",
    "fetch_limited": """SELECT id, serial, detector, stamp FROM stamped
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY stamp DESC, rank, serial) = 1
        ORDER BY stamp DESC, rank, serial, id LIMIT 100""",
    "booking_view": "SELECT " + ", ".join(f"{_VIEW.get(c, c)} AS {c}" for c in COLUMNS) + " FROM m6",
    "refresh_read_model": f"""SELECT {_MODEL} FROM read_model
          WHERE booking_id NOT IN (SELECT id FROM missing UNION SELECT id FROM dup)
        UNION ALL {_FRESH} WHERE p.booking_id IN (SELECT id FROM missing UNION SELECT id FROM dup)""",
    "upsert_by_key": f"""SELECT {_MODEL} FROM read_model WHERE booking_id NOT IN (SELECT booking_id FROM pod WHERE ptf_no IS NULL)
        UNION ALL {_FRESH} WHERE p.ptf_no IS NULL""",
    "process_events": """SELECT id, serial FROM (SELECT *, string_split(serial, '-')[-1] AS seg FROM whole_ar) q
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY seg, serial) = 1
          OR (NOT id LIKE '%5' AND row_number() OVER (PARTITION BY id ORDER BY seg, serial) = 2)""",
    "refresh_stream": f"SELECT {_EVENT} FROM newest",
    "append_and_read_ledger": f"SELECT {_EVENT}, '{AS_OF}' AS day FROM ledger WHERE id NOT LIKE '%1'",
    "scalar_functions": """SELECT doc_num, serial, concat(pv_no, '/', doc_num) AS joined,
          strftime(create_date, '%Y%m%d') AS day_text, '19980601130509' AS now_stamp, '19980601010509' AS now_stamp_12h,
          translate(trim(pv_no), ' ,', '') AS squeezed,
          array_to_string(list_transform(string_split(pv_no, ','), lambda x: trim(x)), '|') AS tokens,
          coalesce(pv_no, 'none') AS or_default, seg AS segment,
          CAST(substr(seg, 1, 8) || lpad(substr(seg, 9), 6, '0') AS BIGINT) AS stamp, CAST(seg AS BIGINT) AS legacy_stamp,
          CAST(CAST(doc_num AS VARCHAR) || '000.5' AS DOUBLE) AS parsed, nullif(pv_no, '') AS null_if,
          CAST(update_date - create_date AS INT) AS days, substr(pv_no, 2, 3) AS part
        FROM (SELECT *, strftime(update_date, '%Y%m%d') || update_ts AS seg,
                'AP' || doc_num || '-' || strftime(update_date, '%Y%m%d') || update_ts AS serial FROM heads
              WHERE create_date <= DATE'1998-06-01' OR update_date <= DATE'1998-06-01') h""",
    "exploded_tokens": f"SELECT booking_id, unnest({_TOKENS}) AS token FROM tp",
    "penalty_metrics": """SELECT booking_id, client_sub_overdue, client_penalty, strftime(deadline, '%Y-%m-%d') AS submit_deadline,
        overdue_days, payment_status, carrier_penalty, lost_penalty, total_sub_penalties, total_penalty_waived FROM m6""",
    "sql_cell_tokens": """SELECT booking_id, CAST(generate_subscripts(cells, 1) - 1 AS INT) AS position,
        trim(unnest(cells)) AS token, true AS known
        FROM (SELECT booking_id, string_split(pv_no, ',') AS cells FROM tp WHERE pv_no IS NOT NULL) q""",
    "net_of_vat": """SELECT booking_id, CASE coalesce(vat_status, 'Y') WHEN 'Y' THEN gross_rates
        WHEN 'N' THEN gross_rates / 1.12::DOUBLE END AS net
        FROM pricing LEFT JOIN partner k ON k.code = 'S' || (CAST(booking_id AS BIGINT) % 120)""",
    "scrub_rates": """SELECT booking_id, CASE WHEN amount <> 'NaN' OR NOT v THEN amount END AS amount,
        CASE WHEN addl_amount <> 'NaN' OR NOT v THEN addl_amount END AS addl_amount
        FROM (SELECT *, booking_id IN (SELECT booking_id FROM pod WHERE status_detail = 'Verified') AS v FROM rates_staging) q""",
    "lock_holds": f"SELECT {_HOLD} FROM holds",
    "queue_position": """SELECT s.grp, s.row_id, s.client, s.enter AS enter_id, count(o.enter) AS queue_position FROM stints s
        LEFT JOIN stints o ON o.grp = s.grp AND o.row_id = s.row_id AND o.enter < s.enter
          AND coalesce(o.leave, 9e18::BIGINT) > s.enter GROUP BY ALL""",
    "registration_replies": """SELECT event_id, client AS recipient, session_id, grp,
        CASE WHEN holder IS NULL THEN '' ELSE row_id END AS ids, coalesce('u' || holder, '') AS holders
        FROM held WHERE event_type = 'view'""",
    "release_notices": "SELECT granted AS event_id, client AS recipient, grp, row_id FROM holds WHERE granted <> enter",
    "unlock_requests": """SELECT event_id, coalesce(holder, client) AS recipient,
        CASE WHEN holder IS NULL THEN session_id ELSE '' END AS session_id,
        CASE WHEN holder IS NULL THEN 'FAILED' ELSE 'REQUEST' END AS status, grp, row_id,
        CASE WHEN holder IS NOT NULL THEN client END AS requestor FROM held WHERE event_type = 'click'""",
    "update_recipients": "SELECT event_id, sender, recipient, grp FROM told",
    "outbox": "SELECT event_id, kind, recipient, session_id, event, status, grp, ids FROM sent",
    "keyed_lock_holds": f"SELECT {_HOLD} FROM holds",
    "keyed_lock_outbox": "SELECT event_id, kind, recipient, session_id, event, status, grp, ids FROM sent",
    "keyed_lock_rejects": "SELECT event_id, 'malformed' AS reason FROM junk WHERE event_id % 10 NOT IN (7, 8)",
    "lock_stream_holds": f"SELECT {_HOLD} FROM holds",
    "lock_stream_outbox": "SELECT event_id, kind, recipient, session_id, event, status, grp, ids FROM sent",
    "lock_stream_rejects": "SELECT event_id, 'malformed' AS reason FROM junk WHERE event_id % 10 NOT IN (7, 8)",
}


# The same results by other ways: a bucketed model, SQL functions.
for _other, _same in {
    "refresh_bucketed": "refresh_read_model", "levels_bucketed": "detect_levels", "sql_penalty_metrics": "penalty_metrics",
}.items():
    BODIES[_other] = BODIES[_same]


def _with_roles(body: str) -> str:
    """``body`` behind the role views it uses, directly or through others, in their declared order."""
    used, text = set(), [body]
    while text:
        current = text.pop()
        for name, sql in ROLES.items():
            if name not in used and any(f"{w} {name}" in current for w in ("FROM", "JOIN")):
                used.add(name)
                text.append(sql)
    views = ", ".join(f"{name} AS ({sql})" for name, sql in ROLES.items() if name in used)
    return f"WITH {views} SELECT * FROM ({body}) result" if views else body


def oracles() -> dict[str, str]:
    return {name: _with_roles(body) for name, body in BODIES.items()}
