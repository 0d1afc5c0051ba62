"""The same questions in SQL, written without a look at the DataFrame plans."""

from __future__ import annotations

RENTALS = """
rentals AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS rental_id,
         CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         p_brand AS make, p_type AS model, p_size AS year,
         CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CAST((l_orderkey + 3 * l_linenumber) % 15 AS INTEGER) AS end_date,
         cn.n_name AS pickup_location, sn.n_name AS dropoff_location,
         l_extendedprice AS amount, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(date_trunc('year', o_orderdate) AS DATE) AS batch_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
)"""

FLAT = """
  rental_id, customer_id, make, model, year, CAST(start_date AS VARCHAR) AS start_date,
  CAST(end_date AS VARCHAR) AS end_date, pickup_location, dropoff_location, amount, quantity,
  batch_date"""

COMPLETE = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ("rental_id", "customer_id", "make", "model", "year", "start_date", "end_date",
              "pickup_location", "dropoff_location", "amount", "quantity")
)

AVERAGE = """CAST(ROUND(CAST(amount * quantity / NULLIF(end_date - start_date, 0)
    AS DECIMAL(28,6)), 2) AS DOUBLE)"""

MEASURED = f"""{RENTALS},
measured AS (
  SELECT *, CAST(end_date - start_date AS INTEGER) AS rental_duration_days,
         amount * quantity AS total_rental_amount,
         {AVERAGE} AS average_daily_rental_amount,
         COALESCE(end_date - start_date > 7, FALSE) AS is_long_rental
  FROM rentals WHERE {COMPLETE}
)"""

CAR_DIM = """
car_dim AS (
  SELECT car_key, 'CAR' || lpad(CAST(car_key AS VARCHAR), 9, '0') AS car_id, make, model, year
  FROM (SELECT *, row_number() OVER (ORDER BY md5(nk), nk) AS car_key
        FROM (SELECT DISTINCT p_brand AS make, p_type AS model, p_size AS year,
                     p_brand || '|' || p_type || '|' || CAST(p_size AS VARCHAR) AS nk
              FROM part WHERE p_size <= 45))
)"""

LOCATION_DIM = """
location_dim AS (
  SELECT CAST(n_nationkey AS BIGINT) + 1 AS location_key,
         'LOC' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS location_id,
         n_name AS location_name
  FROM nation WHERE n_nationkey % 10 <> 9
)"""


def _calendar(first: str, last: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter
  FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS d)"""


DATE_DIM = f"""
date_dim AS ({_calendar("TIMESTAMP '1996-01-01'", "TIMESTAMP '2001-12-31'")}
)"""

CUSTOMERS = """
batch_1 AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS email,
         CAST(c_nationkey AS VARCHAR) AS phone
  FROM customer WHERE c_custkey % 10 < 8
),
batch_2 AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
         CASE WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS email,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS phone
  FROM customer WHERE c_custkey % 10 >= 2
)"""

VERSION = "customer_key, customer_id, name, email, phone, effective_date, end_date, is_current"
NULL_SAFE = " OR ".join(f"d.{a} IS DISTINCT FROM b.{a}" for a in ("name", "email", "phone"))
NULL_UNSAFE = " OR ".join(f"d.{a} <> b.{a}" for a in ("name", "email", "phone"))
BY_ID = "customer_id"
BY_ROW = """'{"customer_id":"' || customer_id || '","name":' || COALESCE('"' || name || '"', 'null')
         || ',"email":' || COALESCE('"' || email || '"', 'null')
         || ',"phone":' || COALESCE('"' || phone || '"', 'null') || ',"_copy":1}'"""


def _dim_1(day: str) -> str:
    return f"""{CUSTOMERS},
dim_1 AS (
  SELECT row_number() OVER (ORDER BY md5(customer_id), customer_id) AS customer_key,
         customer_id, name, email, phone, TIMESTAMP '{day}' AS effective_date,
         CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current
  FROM batch_1
)"""


def _closed(day: str, change: str) -> str:
    return f"""
hit AS (SELECT d.customer_id FROM dim_1 d JOIN batch_2 b ON d.customer_id = b.customer_id WHERE {change}),
closed AS (
  SELECT customer_key, customer_id, name, email, phone, effective_date,
         CASE WHEN customer_id IN (SELECT customer_id FROM hit) THEN TIMESTAMP '{day}' ELSE end_date END AS end_date,
         customer_id NOT IN (SELECT customer_id FROM hit) AS is_current
  FROM dim_1
)"""


def _opened(day: str, where: str, natural: str = BY_ID) -> str:
    return f"""
opened AS (
  SELECT (SELECT max(customer_key) FROM dim_1)
         + row_number() OVER (ORDER BY md5({natural}), {natural}) AS customer_key, customer_id, name, email, phone,
         TIMESTAMP '{day}' AS effective_date, CAST(NULL AS TIMESTAMP) AS end_date, TRUE AS is_current
  FROM batch_2 WHERE {where}
)"""


NEW_OR_CHANGED = """customer_id IN (SELECT customer_id FROM hit)
     OR customer_id NOT IN (SELECT customer_id FROM dim_1)"""

DAY_1, DAY_2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
BOTH = f"customer_dim AS (SELECT {VERSION} FROM closed UNION ALL SELECT {VERSION} FROM opened)"


def _documented(first: str, second: str) -> str:
    return ",".join((_dim_1(first), _closed(second, NULL_SAFE), _opened(second, NEW_OR_CHANGED), BOTH))


DOCUMENTED = _documented(DAY_1, DAY_2)
EARLY = _documented("1998-01-01 00:00:00", "2000-01-01 00:00:00")
LITERAL = ",".join((_dim_1(DAY_1), _closed(DAY_2, NULL_UNSAFE), _opened(DAY_2, "TRUE", BY_ROW), BOTH))
DAY_1_ONLY = f"{_dim_1(DAY_1)}, customer_dim AS (SELECT * FROM dim_1)"

WITH_CAR = f"{MEASURED},{CAR_DIM}"
CAR_JOIN = "measured m JOIN car_dim c ON m.make = c.make AND m.model = c.model AND m.year = c.year"

MEASURES = """m.amount, m.quantity, m.rental_duration_days, m.total_rental_amount,
         m.average_daily_rental_amount, m.is_long_rental"""

FACT = f"""{WITH_CAR},{LOCATION_DIM},{DATE_DIM},{DOCUMENTED},
fact AS (
  SELECT m.rental_id, cu.customer_key, c.car_key, p.location_key AS pickup_location_key,
         q.location_key AS dropoff_location_key, s.date_key AS start_date_key,
         e.date_key AS end_date_key, {MEASURES}, m.batch_date
  FROM {CAR_JOIN}
  LEFT JOIN location_dim p ON m.pickup_location = p.location_name
  LEFT JOIN location_dim q ON m.dropoff_location = q.location_name
  LEFT JOIN date_dim s ON m.start_date = s.date
  LEFT JOIN date_dim e ON m.end_date = e.date
  LEFT JOIN (SELECT * FROM customer_dim WHERE is_current) cu ON m.customer_id = cu.customer_id
)"""
FACT_COLUMNS = """rental_id, customer_key, car_key, pickup_location_key, dropoff_location_key,
  start_date_key, end_date_key, amount, quantity, rental_duration_days, total_rental_amount,
  average_daily_rental_amount, is_long_rental"""

SNAPSHOTS = """
snapshots AS (
  SELECT CAST(o_custkey AS VARCHAR) AS customer_id, 'Customer' AS name, o_orderstatus AS email,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS phone,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS batch_date,
         o_orderdate AS seen_at, o_orderkey AS seen_key
  FROM orders
)"""

VERSIONS = f"""{SNAPSHOTS},
daily AS (
  SELECT * FROM snapshots
  QUALIFY row_number() OVER (PARTITION BY customer_id, batch_date ORDER BY seen_at DESC, seen_key DESC) = 1
),
marked AS (
  SELECT *, row_number() OVER w = 1
            OR name IS DISTINCT FROM lag(name) OVER w
            OR email IS DISTINCT FROM lag(email) OVER w
            OR phone IS DISTINCT FROM lag(phone) OVER w AS starts
  FROM daily WINDOW w AS (PARTITION BY customer_id ORDER BY batch_date)
),
versions AS (
  SELECT customer_id, name, email, phone, CAST(batch_date AS TIMESTAMP) AS effective_date,
         CAST(lead(batch_date) OVER (PARTITION BY customer_id ORDER BY batch_date) AS TIMESTAMP) AS end_date
  FROM marked WHERE starts
),
history AS (
  SELECT row_number() OVER (ORDER BY md5(customer_id || '|' || CAST(effective_date AS VARCHAR)),
                            customer_id || '|' || CAST(effective_date AS VARCHAR)) AS customer_key,
         customer_id, name, email, phone, effective_date, end_date, end_date IS NULL AS is_current
  FROM versions
)"""

REVENUE = """CAST(SUM(TRY_CAST(total_rental_amount AS DECIMAL(28,2))) AS DOUBLE) AS revenue,
       count(total_rental_amount) - count(TRY_CAST(total_rental_amount AS DECIMAL(28,2))) AS amounts_left_out"""


def _versioned(dim: str, join: str, key: str = "cu.customer_key") -> str:
    return f"""WITH {WITH_CAR},{dim}
SELECT m.rental_id, c.car_key, m.start_date, {key} AS customer_key
FROM {CAR_JOIN} {join}"""


INTERVAL_JOIN = """LEFT JOIN customer_dim cu ON m.customer_id = cu.customer_id
  AND cu.effective_date <= m.start_date AND (cu.end_date IS NULL OR m.start_date < cu.end_date)"""
FIRST_JOIN = f"""{INTERVAL_JOIN}
LEFT JOIN (SELECT customer_id, min(effective_date) AS began, min_by(customer_key, effective_date) AS first_key
           FROM customer_dim GROUP BY customer_id) f
  ON m.customer_id = f.customer_id AND m.start_date < f.began"""

# Table -> columns with their kind: d double, n other number, x anything else.
PROFILED = {
    "car_dim": "car_key:n car_id:x make:x model:x year:n",
    "location_dim": "location_key:n location_id:x location_name:x",
    "date_dim": "date_key:n date:x year:n month:n day:n quarter:n",
    "customer_dim": "customer_key:n customer_id:x name:x email:x phone:x effective_date:x end_date:x is_current:x",
    "rentals_fact": "rental_id:x customer_key:n car_key:n pickup_location_key:n dropoff_location_key:n "
                    "start_date_key:n end_date_key:n amount:d quantity:n rental_duration_days:n "
                    "total_rental_amount:d average_daily_rental_amount:d is_long_rental:x",
    "rentals": "rental_id:x customer_id:x make:x model:x year:n start_date:x end_date:x "
               "pickup_location:x dropoff_location:x amount:d quantity:n",
}


def _profile() -> str:
    lines = []
    for name, columns in PROFILED.items():
        source = "fact" if name == "rentals_fact" else name
        for column, kind in (c.split(":") for c in columns.split()):
            below = "CAST(NULL AS BIGINT)" if kind == "x" else f"count(*) FILTER ({column} <= 0)"
            text = "CAST(CAST({} AS DECIMAL(28,2)) AS VARCHAR)" if kind == "d" else "CAST({} AS VARCHAR)"
            lines.append(
                f"SELECT '{name}' AS table_name, '{column}' AS column_name, count(*) AS row_count, "
                f"count(*) - count({column}) AS null_count, {below} AS not_positive_count, "
                f"{text.format(f'min({column})')} AS min_value, "
                f"{text.format(f'max({column})')} AS max_value FROM {source}"
            )
    return f"WITH {FACT}\n" + "\nUNION ALL ".join(lines)


def _nulls() -> str:
    declared = {
        "location_dim": ("location_key", "location_id"),
        "car_dim": ("car_key", "car_id"),
        "date_dim": ("date_key", "date"),
        "customer_dim": ("customer_key", "customer_id", "email", "phone"),
        "rentals_fact": ("rental_id", "customer_key", "pickup_location_key"),
        "rentals": ("rental_id", "customer_id"),
    }
    lines = [
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count "
        f"FROM {'fact' if name == 'rentals_fact' else name}"
        for name, columns in declared.items() for c in columns
    ]
    return f"WITH {FACT}\n" + "\nUNION ALL ".join(lines)


def _duplicates() -> str:
    unique = (
        ("location_dim", ("location_key",)), ("location_dim", ("location_id",)),
        ("car_dim", ("car_key",)), ("car_dim", ("car_id",)), ("car_dim", ("make", "model", "year")),
        ("date_dim", ("date_key",)), ("date_dim", ("date",)),
        ("customer_dim", ("customer_key",)), ("customer_dim", ("customer_id", "effective_date")),
        ("rentals_fact", ("rental_id",)),
    )
    lines = []
    for name, columns in unique:
        value = " || '|' || ".join(f"COALESCE(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
        lines.append(
            f"SELECT '{name}' AS table_name, '{','.join(columns)}' AS key_columns, {value} AS key_value, "
            f"count(*) AS row_count FROM {'fact' if name == 'rentals_fact' else name} "
            f"GROUP BY {', '.join(columns)} HAVING count(*) > 1"
        )
    return f"WITH {FACT}\n" + "\nUNION ALL ".join(lines)


def _orphans() -> str:
    known = {
        "customer_key": "SELECT customer_key FROM dim_1",
        "car_key": "SELECT car_key FROM car_dim WHERE year <= 40",
        "pickup_location_key": "SELECT location_key FROM location_dim WHERE location_key > 1",
        "dropoff_location_key": "SELECT location_key FROM location_dim WHERE location_key > 1",
        "start_date_key": "SELECT date_key FROM date_dim WHERE year >= 1997",
        "end_date_key": "SELECT date_key FROM date_dim WHERE year >= 1997",
    }
    lines = [
        f"SELECT '{key}' AS foreign_key, count({key}) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys "
        f"FROM fact WHERE {key} NOT IN ({keys})"
        for key, keys in known.items()
    ]
    return f"WITH {FACT}\n" + "\nUNION ALL ".join(lines)


def _unresolved() -> str:
    roles = {
        "car": ("make || '|' || model || '|' || CAST(year AS VARCHAR)",
                "SELECT make || '|' || model || '|' || CAST(year AS VARCHAR) FROM car_dim"),
        "customer": ("customer_id", "SELECT customer_id FROM dim_1"),
        "dropoff_location": ("dropoff_location", "SELECT location_name FROM location_dim"),
        "end_date": ("CAST(end_date AS VARCHAR)", "SELECT CAST(date AS VARCHAR) FROM date_dim"),
        "pickup_location": ("pickup_location", "SELECT location_name FROM location_dim"),
        "start_date": ("CAST(start_date AS VARCHAR)", "SELECT CAST(date AS VARCHAR) FROM date_dim"),
    }
    lines = [
        f"SELECT '{role}' AS role, {value} AS natural_value, count(*) AS rentals FROM measured "
        f"WHERE {value} NOT IN ({known}) GROUP BY {value}"
        for role, (value, known) in roles.items()
    ]
    return f"WITH {WITH_CAR},{LOCATION_DIM},{DATE_DIM},{_dim_1(DAY_1)}\n" + "\nUNION ALL ".join(lines)


def _invariants() -> str:
    def rules(label: str, dim: str) -> str:
        pairs = (
            f"SELECT a.customer_id FROM {dim} a JOIN {dim} b ON a.customer_id = b.customer_id "
            "AND a.customer_key < b.customer_key "
            "AND a.effective_date < COALESCE(b.end_date, TIMESTAMP '9999-12-31') "
            "AND b.effective_date < COALESCE(a.end_date, TIMESTAMP '9999-12-31')"
        )
        return f"""
SELECT '{label}' AS dimension, 'many_current' AS rule, count(*) AS violations
  FROM (SELECT customer_id FROM {dim} WHERE is_current GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT '{label}', 'overlap', count(DISTINCT customer_id) FROM ({pairs})
UNION ALL SELECT '{label}', 'flag_mismatch', count(*) FROM {dim} WHERE is_current <> (end_date IS NULL)
UNION ALL SELECT '{label}', 'repeated_start', count(*) - count(DISTINCT (customer_id, effective_date)) FROM {dim}"""

    literal = LITERAL
    for name in ("hit", "closed", "opened", "customer_dim"):
        literal = literal.replace(f"{name} AS (", f"{name}_l AS (")
        literal = literal.replace(f"FROM {name})", f"FROM {name}_l)").replace(f"FROM {name} ", f"FROM {name}_l ")
    literal = literal[literal.index("hit_l AS"):]
    return f"WITH {DOCUMENTED},\n{literal}\n{rules('documented', 'customer_dim')}\nUNION ALL {rules('literal', 'customer_dim_l')}"


# Fixed values, written out apart from the code under test.
SEED_LOCATIONS = (
    "New York - JFK Airport",
    "Los Angeles - LAX Airport",
    "Chicago - OHare Airport",
    "Houston - Bush Intercontinental Airport",
    "San Francisco - SFO Airport",
    "Miami - MIA Airport",
    "Seattle - SeaTac Airport",
    "Atlanta - Hartsfield-Jackson Airport",
    "Dallas - DFW Airport",
    "Denver - DEN Airport",
)
SEED_CARS = (
    ("Toyota", "Camry", 2020),
    ("Honda", "Civic", 2019),
    ("Ford", "Mustang", 2021),
    ("Chevrolet", "Impala", 2018),
    ("Tesla", "Model S", 2022),
    ("BMW", "3 Series", 2021),
    ("Audi", "A4", 2020),
    ("Mercedes-Benz", "C-Class", 2019),
    ("Volkswagen", "Passat", 2021),
    ("Nissan", "Altima", 2020),
)


def _seeds() -> str:
    locations = ", ".join(
        f"('location_key', {i}, 'LOC{i:03d}', '{name}')" for i, name in enumerate(SEED_LOCATIONS, 1)
    )
    cars = ", ".join(
        f"('car_key', {i}, 'CAR{i:03d}', '{make} {model} {year}')"
        for i, (make, model, year) in enumerate(SEED_CARS, 1)
    )
    return f"""
WITH seeds(dim, key, id, value) AS (
  SELECT col0, CAST(col1 AS BIGINT), col2, col3 FROM (VALUES {locations}, {cars})
  UNION ALL
  SELECT 'date_key', CAST(strftime(d, '%Y%m%d') AS BIGINT), strftime(d, '%Y%m%d'), strftime(d, '%Y-%m-%d')
  FROM (SELECT unnest(generate_series(TIMESTAMP '2025-09-01', TIMESTAMP '2025-09-30', INTERVAL 1 DAY)) AS d)
),
uses AS (
  SELECT 'location_key' AS dim, o_custkey % 10 + 1 AS key FROM orders
  UNION ALL SELECT 'car_key', o_orderkey % 10 + 1 FROM orders
  UNION ALL SELECT 'date_key', 20250900 + day(o_orderdate) FROM orders
)
SELECT s.dim, s.key, s.id, s.value, count(u.key) AS orders
FROM seeds s LEFT JOIN uses u ON s.dim = u.dim AND s.key = u.key
GROUP BY s.dim, s.key, s.id, s.value"""


def _drift() -> str:
    fields = (
        ("amount", "'double'", "'string'", "retyped", "count(amount)"),
        ("car.make", "'string'", "'string'", "same", "count(make)"),
        ("car.model", "'string'", "'string'", "same", "count(model)"),
        ("car.year", "'int'", "'bigint'", "same", "count(year)"),
        ("channel", "NULL", "'string'", "added", "count(make)"),
        ("customer_id", "'string'", "'string'", "same", "count(customer_id)"),
        ("quantity", "'int'", "NULL", "missing", "0 * count(*)"),
        ("rental_id", "'string'", "'string'", "same", "count(rental_id)"),
        ("rental_location.dropoff_location", "'string'", "'string'", "same", "count(dropoff_location)"),
        ("rental_location.pickup_location", "'string'", "'string'", "same", "count(pickup_location)"),
        ("rental_period.end_date", "'string'", "'string'", "same", "count(end_date)"),
        ("rental_period.start_date", "'string'", "'string'", "same", "count(start_date)"),
    )
    lines = [
        f"SELECT '{name}' AS field, CAST({declared} AS VARCHAR) AS declared_type, "
        f"CAST({found} AS VARCHAR) AS found_type, '{status}' AS status, {rows} AS present_rows FROM rentals"
        for name, declared, found, status, rows in fields
    ]
    return f"WITH {RENTALS}\n" + "\nUNION ALL ".join(lines)


MISSING = " || ".join(["CASE WHEN customer_id IS NULL THEN 'customer_id' ELSE '' END"])
DURATION = "CAST(end_date - start_date AS INTEGER) AS rental_duration_days"
DATED_FACT = f"WITH {FACT} SELECT {FACT_COLUMNS}, batch_date FROM fact"

# The customer history from batches of two years, whatever order they came in.
RARE = VERSIONS.replace(
    "CAST(date_trunc('month', o_orderdate) AS DATE)", "make_date(year(o_orderdate) - (year(o_orderdate) + 1) % 2, 1, 1)"
)

RAW_RENTALS = f"""{RENTALS},
texts AS (
  SELECT *, CAST(split_part(rental_id, '-', 1) AS BIGINT) AS o,
         CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) AS price, CAST(quantity AS VARCHAR) AS q
  FROM rentals
),
lines AS (
  SELECT *, o % 17 = 0 AS broken,
         '{{"rental_id": "' || rental_id || '", "customer_id": ' || COALESCE('"' || customer_id || '"', 'null')
         || ', "car": {{"make": "' || make || '", "model": "' || model || '", "year": '
         || CASE WHEN o % 13 = 0 THEN 'true' ELSE CAST(year AS VARCHAR) END
         || '}},  "rental_period": {{"start_date": "' || start_date || '", "end_date": "' || end_date
         || '"}}, "rental_location": {{"pickup_location": "' || pickup_location
         || '", "dropoff_location": "' || dropoff_location || '"}}, "amount": '
         || CASE WHEN o % 11 = 0 THEN '"' || price || '"' ELSE price END
         || ', "quantity": ' || q || CASE WHEN o % 7 = 0 THEN '.5' ELSE '' END
         || ', "channel": {{"n": [1.0, ' || q || ']}}}}' AS line
  FROM texts
)"""

ORACLE: dict[str, str] = {
    "chk_lookup_suggestions": f"""WITH {MEASURED},{CAR_DIM},{LOCATION_DIM},
spelt AS (
  SELECT CASE o % 5 WHEN 0 THEN replace(make, '#', '') WHEN 1 THEN reverse(make) ELSE make END AS make,
         CASE WHEN o % 7 = 0 THEN concat(model, chr(39), 's') ELSE model END AS model, year,
         CASE WHEN o % 3 = 0 THEN replace(pickup_location, '_', ' -') ELSE pickup_location END AS pickup_location, dropoff_location
  FROM (SELECT *, CAST(split_part(rental_id, '-', 1) AS BIGINT) AS o FROM measured)
),
named AS (
  SELECT 'car' AS role, make || '|' || model || '|' || CAST(year AS VARCHAR) AS natural_value FROM spelt
  UNION ALL SELECT 'pickup_location', pickup_location FROM spelt
  UNION ALL SELECT 'dropoff_location', dropoff_location FROM spelt
),
known AS (
  SELECT 'car' AS role, make || '|' || model || '|' || CAST(year AS VARCHAR) AS name FROM car_dim
  UNION ALL SELECT 'pickup_location', location_name FROM location_dim
  UNION ALL SELECT 'dropoff_location', location_name FROM location_dim
),
unresolved AS (
  SELECT role, natural_value, count(*) AS rentals FROM named
  WHERE (role, natural_value) NOT IN (SELECT (role, name) FROM known) GROUP BY role, natural_value
),
near AS (
  SELECT u.role, natural_value, CAST(levenshtein(natural_value, name) AS INTEGER) AS edits, name
  FROM unresolved u JOIN known k ON u.role = k.role AND levenshtein(natural_value, name) <= 2
),
best AS (SELECT role, natural_value, min({{'e': edits, 'n': name}}) AS b FROM near GROUP BY role, natural_value)
SELECT u.role, u.natural_value, rentals, b['n'] AS suggestion, b['e'] AS edits
FROM unresolved u LEFT JOIN best USING (role, natural_value)""",
    "src_load_ledger": f"""WITH {RENTALS}
SELECT CAST(batch_date AS VARCHAR) AS batch_date, count(*) AS reported_rows, count(*) AS rows,
       CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, batch_date = DATE '1995-01-01' AS changed
FROM rentals GROUP BY batch_date""",
    "src_schema_evolution": f"""WITH {RENTALS}
SELECT rental_id, customer_id, make, CAST(year AS BIGINT) AS car_year, CASE WHEN y >= 2000 THEN upper(make) END AS label,
       CASE WHEN y > 1996 THEN CAST(start_date AS VARCHAR) END AS start_date,
       CAST(CAST(CASE WHEN y BETWEEN 1997 AND 1999 THEN CAST(amount AS DECIMAL(14,2)) ELSE floor(amount) END
            AS DECIMAL(21,2)) AS VARCHAR) AS amount,
       CAST(quantity AS BIGINT) AS quantity, CASE WHEN y >= 2000 THEN 'web' END AS channel, CAST(y AS BIGINT) AS year
FROM (SELECT *, year(batch_date) AS y FROM rentals)""",
    "chk_drift": f"""WITH {RENTALS},
shifted AS (
  SELECT batch_date AS day, CASE WHEN year(batch_date) = 1998 THEN amount * 1.5::DOUBLE ELSE amount END AS amount,
         CAST(end_date - start_date AS DOUBLE) AS rental_duration_days, make,
         CASE WHEN year(batch_date) = 1999 AND quantity % 2 = 0 THEN 'NATION_0' ELSE pickup_location END AS pickup_location,
         CASE WHEN customer_id IS NULL THEN 'true' ELSE 'false' END AS customer
  FROM rentals
),
days AS (SELECT day, count(*) AS total, lag(day) OVER (ORDER BY day) AS previous, lag(count(*)) OVER (ORDER BY day) AS previous_total
         FROM shifted GROUP BY day),
numbers AS (
  SELECT day, column_name, CAST(round(CAST(value AS DECIMAL(28,6)) * 100, 0) AS BIGINT) AS v
  FROM (UNPIVOT (SELECT day, amount, rental_duration_days FROM shifted) ON amount, rental_duration_days INTO NAME column_name VALUE value)
),
steps AS (
  SELECT day, column_name, v // u * u AS item, count(*) AS n
  FROM (SELECT *, CAST(pow(10, greatest(length(CAST(abs(v) AS VARCHAR)) - 3, 0)) AS BIGINT) AS u FROM numbers) GROUP BY ALL
),
words AS (
  SELECT day, column_name, value, count(*) AS n
  FROM (UNPIVOT (SELECT day, make, pickup_location, customer FROM shifted) ON make, pickup_location, customer INTO NAME column_name VALUE value)
  GROUP BY ALL
),
frequent AS (
  SELECT w.day, column_name, CASE WHEN n * 1000 >= total THEN value ELSE '<other>' END AS item, sum(n) AS n
  FROM words w JOIN days d ON w.day = d.day GROUP BY ALL
),
number_sides AS (
  SELECT d.day, s.column_name, s.item, sum(CASE WHEN s.day = d.day THEN n ELSE 0 END)::HUGEINT AS now,
         sum(CASE WHEN s.day = d.previous THEN n ELSE 0 END)::HUGEINT AS earlier
  FROM days d JOIN steps s ON s.day IN (d.day, d.previous) WHERE d.previous IS NOT NULL GROUP BY ALL
),
number_apart AS (
  SELECT s.day, column_name, item, now, abs(sum(now) OVER w * previous_total - sum(earlier) OVER w * total) AS apart, total, previous, previous_total
  FROM number_sides s JOIN days d ON s.day = d.day WINDOW w AS (PARTITION BY s.day, column_name ORDER BY item)
),
word_sides AS (
  SELECT d.day, s.column_name, s.item, sum(CASE WHEN s.day = d.day THEN n ELSE 0 END)::HUGEINT AS now,
         sum(CASE WHEN s.day = d.previous THEN n ELSE 0 END)::HUGEINT AS earlier
  FROM days d JOIN frequent s ON s.day IN (d.day, d.previous) WHERE d.previous IS NOT NULL GROUP BY ALL
)
SELECT column_name, day, any_value(previous) AS previous, any_value(total) AS rows, CAST(0 AS BIGINT) AS nulls,
       CAST(sum(CASE WHEN item <= 0 THEN now ELSE 0 END) AS BIGINT) AS not_positive,
       CAST(max(apart) * 1000 // (any_value(total)::HUGEINT * any_value(previous_total)) AS BIGINT) AS distance_per_mille
FROM number_apart GROUP BY column_name, day
UNION ALL
SELECT column_name, s.day, any_value(previous), any_value(total), NULL, NULL,
       CAST(sum(abs(now * previous_total - earlier * total)) * 500 // (any_value(total)::HUGEINT * any_value(previous_total)) AS BIGINT)
FROM word_sides s JOIN days d ON s.day = d.day GROUP BY column_name, s.day""",
    "src_rental_array": f"""WITH {RENTALS}
SELECT {FLAT.replace("batch_date", "").rstrip().rstrip(",")} FROM rentals""",
    "flt_rejected_raw": f"""WITH {RAW_RENTALS}
SELECT CASE WHEN NOT broken THEN rental_id END AS rental_id,
       CASE WHEN broken THEN split_part(line, '"car"', 1) ELSE line END AS raw,
       CASE WHEN broken THEN 'rental_id,customer_id,car.make,car.model,car.year,rental_period.start_date,'
            || 'rental_period.end_date,rental_location.pickup_location,rental_location.dropoff_location,amount,quantity'
       ELSE concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer_id' END,
            CASE WHEN o % 13 = 0 THEN 'car.year' END, CASE WHEN o % 11 = 0 THEN 'amount' END,
            CASE WHEN o % 7 = 0 THEN 'quantity' END) END AS missing_fields
FROM lines WHERE broken OR customer_id IS NULL OR o % 13 = 0 OR o % 11 = 0 OR o % 7 = 0""",
    "chk_scd2_incremental": _invariants(),
    "run_late_days": f"""WITH {RARE}
SELECT customer_id, name, email, phone, effective_date, end_date, is_current FROM history""",
    "src_rental_nested": f"WITH {RENTALS} SELECT {FLAT} FROM rentals",
    "src_customer_batch": f"""WITH {CUSTOMERS}
SELECT batch, customer_id, email, phone,
       CASE CAST(customer_id AS BIGINT) % 5 WHEN 0 THEN 'Ann "Al", ' || name
            WHEN 1 THEN name || chr(10) || '2nd line' ELSE name END AS name
FROM (SELECT 'day 1' AS batch, * FROM batch_1 UNION ALL SELECT 'day 2', * FROM batch_2)""",
    "src_batch_slice": f"WITH {RENTALS} SELECT {FLAT} FROM rentals WHERE batch_date = DATE '1998-01-01'",
    "src_batch_date_default": """
SELECT run_date, count(*) AS runs FROM (
  SELECT CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y%m%d')
              ELSE strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') END AS run_date FROM orders)
GROUP BY run_date""",
    "src_seed_dims": _seeds(),
    "src_schema_drift": _drift(),
    "src_load_once": f"WITH {RENTALS} SELECT {FLAT} FROM rentals",
    "flt_valid_rentals": f"WITH {RENTALS} SELECT {FLAT} FROM rentals WHERE {COMPLETE}",
    "flt_rejected_rentals": f"""WITH {RENTALS}
SELECT {FLAT}, {MISSING} AS missing_fields FROM rentals WHERE NOT ({COMPLETE})""",
    "prj_flatten_rental": f"WITH {RENTALS} SELECT {FLAT} FROM rentals",
    "prj_derive_measures": f"""WITH {MEASURED}
SELECT m.rental_id, m.start_date, m.end_date, {MEASURES} FROM measured m""",
    "expr_duration_days": f"""WITH {RENTALS}
SELECT rental_id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
       {DURATION} FROM rentals""",
    "expr_total_amount": f"""WITH {RENTALS}
SELECT rental_id, amount, quantity, amount * quantity AS total_rental_amount FROM rentals""",
    "expr_avg_daily_amount": f"""WITH {RENTALS}
SELECT rental_id, {DURATION}, {AVERAGE} AS average_daily_rental_amount FROM rentals""",
    "expr_long_rental_flag": f"""WITH {RENTALS}
SELECT rental_id, {DURATION}, end_date - start_date > 7 AS is_long_rental FROM rentals""",
    "dim_date": _calendar(
        "(SELECT date_trunc('day', min(o_orderdate)) FROM orders)",
        "(SELECT date_trunc('day', max(o_orderdate)) FROM orders)",
    ),
    "key_surrogate": f"""WITH {CAR_DIM}
SELECT (SELECT max(car_key) FROM car_dim)
       + row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR)), CAST(c_custkey AS VARCHAR)) AS customer_key,
       c_custkey, c_name FROM customer""",
    "fact_car_key": f"""WITH {WITH_CAR}
SELECT m.rental_id, c.car_key, m.total_rental_amount FROM {CAR_JOIN}""",
    "fact_location_keys": f"""WITH {WITH_CAR},{LOCATION_DIM}
SELECT m.rental_id, c.car_key, p.location_key AS pickup_location_key, q.location_key AS dropoff_location_key
FROM {CAR_JOIN}
LEFT JOIN location_dim p ON m.pickup_location = p.location_name
LEFT JOIN location_dim q ON m.dropoff_location = q.location_name""",
    "fact_date_keys": f"""WITH {WITH_CAR},{DATE_DIM}
SELECT m.rental_id, c.car_key, s.date_key AS start_date_key, e.date_key AS end_date_key
FROM {CAR_JOIN}
LEFT JOIN date_dim s ON m.start_date = s.date LEFT JOIN date_dim e ON m.end_date = e.date""",
    "fact_customer_all_versions": _versioned(
        LITERAL, "LEFT JOIN customer_dim cu ON m.customer_id = cu.customer_id"
    ),
    "fact_customer_current": _versioned(
        DAY_1_ONLY, "LEFT JOIN customer_dim cu ON m.customer_id = cu.customer_id AND cu.is_current"
    ),
    "fact_customer_as_of": _versioned(EARLY, INTERVAL_JOIN),
    "fact_customer_as_of_first_open": _versioned(
        EARLY, FIRST_JOIN, "COALESCE(cu.customer_key, f.first_key)"
    ),
    "fact_customer_as_of_hot": f"""WITH {WITH_CAR},{VERSIONS},
hot AS (
  SELECT * REPLACE (CASE WHEN CAST(split_part(rental_id, '-', 1) AS BIGINT) % 3 = 0 THEN '4'
                         ELSE customer_id END AS customer_id) FROM measured
)
SELECT m.rental_id, c.car_key, m.start_date, cu.customer_key
FROM hot m JOIN car_dim c ON m.make = c.make AND m.model = c.model AND m.year = c.year
LEFT JOIN history cu ON m.customer_id = cu.customer_id
  AND cu.effective_date <= m.start_date AND (cu.end_date IS NULL OR m.start_date < cu.end_date)""",
    "fact_rentals": f"WITH {FACT} SELECT {FACT_COLUMNS} FROM fact",
    "scd2_batch_dedup": f"""WITH {SNAPSHOTS}
SELECT * FROM snapshots
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY seen_at DESC, seen_key DESC) = 1""",
    **{
        name: f"""WITH {_dim_1(DAY_1)}
SELECT d.customer_key, d.customer_id, d.name, d.email, d.phone,
       b.name AS new_name, b.email AS new_email, b.phone AS new_phone
FROM dim_1 d JOIN batch_2 b ON d.customer_id = b.customer_id WHERE {change}"""
        for name, change in (("scd2_changed", NULL_SAFE), ("scd2_changed_null_unsafe", NULL_UNSAFE))
    },
    "scd2_close": f"WITH {_dim_1(DAY_1)},{_closed(DAY_2, NULL_SAFE)} SELECT {VERSION} FROM closed",
    "scd2_insert_all": f"WITH {LITERAL} SELECT {VERSION} FROM customer_dim",
    "scd2_insert_changed": f"""WITH {_dim_1(DAY_1)},{_closed(DAY_2, NULL_SAFE)},{_opened(DAY_2, NEW_OR_CHANGED)}
SELECT {VERSION} FROM dim_1 UNION ALL SELECT {VERSION} FROM opened""",
    "scd2_apply": f"WITH {DOCUMENTED} SELECT {VERSION} FROM customer_dim",
    "scd2_history": f"WITH {VERSIONS} SELECT * FROM history",
    "scd2_change_summary": f"""WITH {_dim_1(DAY_1)}
SELECT CASE WHEN d.customer_id IS NULL THEN 'new' WHEN b.customer_id IS NULL THEN 'absent'
            WHEN {NULL_SAFE} THEN 'changed' ELSE 'unchanged' END AS status, count(*) AS customers
FROM dim_1 d FULL JOIN batch_2 b ON d.customer_id = b.customer_id GROUP BY 1""",
    "chk_table_profile": _profile(),
    "chk_nulls": _nulls(),
    "chk_duplicate_keys": _duplicates(),
    "chk_fk_orphans": _orphans(),
    "chk_unresolved_lookups": _unresolved(),
    "chk_scd2_invariants": _invariants(),
    "sink_fact_append": f"""{DATED_FACT}
UNION ALL SELECT {FACT_COLUMNS}, batch_date FROM fact WHERE batch_date = DATE '1998-01-01'""",
    "sink_fact_idempotent": DATED_FACT,
    "run_row_accounts": f"""WITH {RENTALS},{CAR_DIM},
judged AS (
  SELECT r.batch_date, {COMPLETE.replace(" AND ", " AND r.").replace("rental_id IS", "r.rental_id IS", 1)} AS valid, c.car_key IS NOT NULL AS known
  FROM rentals r LEFT JOIN car_dim c ON r.make = c.make AND r.model = c.model AND r.year = c.year
)
SELECT batch_date, count(*) AS read, count(*) FILTER (valid AND known) AS in_fact,
       count(*) FILTER (NOT valid) AS rejected, count(*) FILTER (valid AND NOT known) AS unknown_car
FROM judged GROUP BY batch_date""",
    "run_uncommitted_day": f"""WITH {WITH_CAR},{DAY_1_ONLY}
SELECT m.rental_id, c.car_key, cu.customer_key, m.batch_date
FROM {CAR_JOIN} LEFT JOIN customer_dim cu ON m.customer_id = cu.customer_id
WHERE m.batch_date = DATE '1998-01-01'""",
    "kpi_revenue_by_car": f"""WITH {FACT}
SELECT make, model, year, count(*) AS rentals, {REVENUE}
FROM fact JOIN car_dim USING (car_key) GROUP BY make, model, year""",
    "kpi_revenue_by_location": f"""WITH {FACT}
SELECT 'pickup' AS role, COALESCE(location_name, 'UNKNOWN') AS location_name, count(*) AS rentals, {REVENUE}
FROM fact LEFT JOIN location_dim ON pickup_location_key = location_key GROUP BY 2
UNION ALL
SELECT 'dropoff', COALESCE(location_name, 'UNKNOWN'), count(*), {REVENUE}
FROM fact LEFT JOIN location_dim ON dropoff_location_key = location_key GROUP BY 2""",
    "kpi_long_rental_ratio": f"""WITH {FACT}
SELECT 'car' AS scope, make, model, year, count(*) AS rentals,
       count(*) FILTER (is_long_rental) AS long_rentals,
       avg(CAST(is_long_rental AS INTEGER)) AS long_rental_ratio
FROM fact JOIN car_dim USING (car_key) GROUP BY make, model, year
UNION ALL
SELECT 'overall', NULL, NULL, NULL, count(*), count(*) FILTER (is_long_rental),
       avg(CAST(is_long_rental AS INTEGER)) FROM fact""",
    "kpi_avg_duration": f"""WITH {FACT}
SELECT 'pickup' AS scope, COALESCE(location_name, 'UNKNOWN') AS location_name,
       count(rental_duration_days) AS rentals, avg(rental_duration_days) AS average_duration_days
FROM fact LEFT JOIN location_dim ON pickup_location_key = location_key GROUP BY 2
UNION ALL
SELECT 'overall', NULL, count(rental_duration_days), avg(rental_duration_days) FROM fact""",
    "kpi_tickets_by_segment": f"""WITH {FACT}
SELECT segment, rentals, tickets, revenue, amounts_left_out,
       CAST(ROUND(CAST(revenue / tickets AS DECIMAL(28,6)), 2) AS DOUBLE) AS average_ticket
FROM (SELECT COALESCE(c_mktsegment, 'UNKNOWN') AS segment, count(*) AS rentals, count(DISTINCT rental_id) AS tickets, {REVENUE}
      FROM fact LEFT JOIN customer_dim USING (customer_key)
      LEFT JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR) GROUP BY 1)""",
}

# The fact does not depend on how it was loaded, but for the customers known on the first day.
for _name in ("revenue_by_car", "revenue_by_location", "long_rental_ratio", "avg_duration"):
    ORACLE[f"kpi_state_{_name}"] = ORACLE[f"kpi_{_name}"]
ORACLE["kpi_state_tickets_by_segment"] = f"""WITH {WITH_CAR}
SELECT segment, rentals, tickets, revenue, amounts_left_out,
       CAST(ROUND(CAST(revenue / tickets AS DECIMAL(28,6)), 2) AS DOUBLE) AS average_ticket
FROM (SELECT CASE WHEN m.batch_date < DATE '1998-01-01' AND c_custkey % 10 >= 8 THEN 'UNKNOWN' ELSE c_mktsegment END AS segment,
             count(*) AS rentals, count(DISTINCT rental_id) AS tickets, {REVENUE}
      FROM {CAR_JOIN} JOIN customer ON m.customer_id = CAST(c_custkey AS VARCHAR) GROUP BY 1)"""
