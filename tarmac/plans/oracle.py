"""Independent SQL oracle (DuckDB dialect) for every query key.

The same binding is written here in SQL; each question is then written the
plain way — flat joins over the raw rows, extremes as scalar min/max
subqueries, NOT EXISTS over all city pairs — so that it checks the Spark
plans, which are built differently (pre-aggregation, semi joins on one-row
aggregates, gap enumeration).
"""

from __future__ import annotations

from tarmac.plans.registry import BOUND_PARAMS

BINDING = """
WITH tickets AS (
    SELECT printf('%06d', o.o_custkey) || '-' || CAST(year(o.o_orderdate) AS VARCHAR) AS book_ref,
           o.o_orderkey AS ticket_no,
           printf('%06d', o.o_custkey) || '-' || substr(o.o_orderpriority, 1, 1) AS passenger_id,
           c.c_name || ' ' || substr(o.o_orderpriority, 1, 1) AS passenger_name,
           '{"segment": "' || c.c_mktsegment || '"}' AS contact_data
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
ticket_flights AS (
    SELECT l_orderkey AS ticket_no, l_partkey AS flight_id,
           CAST(l_extendedprice AS DECIMAL(12, 2)) AS amount
    FROM lineitem
),
fv0 AS (
    SELECT p.p_partkey AS flight_id, d.n_name AS departure_city, a.n_name AS arrival_city,
           p.p_brand AS aircraft_code,
           CASE p.p_size % 10 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'Scheduled'
                              WHEN 2 THEN 'Departed' ELSE 'Arrived' END AS status,
           TIMESTAMP '2016-08-01 00:00:00'
               + to_hours(CAST((p.p_partkey * 37) % 1440 AS BIGINT)) AS scheduled_departure,
           p.p_size AS size_, p.p_partkey AS key_
    FROM part p
    JOIN nation d ON d.n_nationkey = p.p_partkey % 25
    JOIN nation a ON a.n_nationkey = (p.p_partkey * 3 + p.p_size) % 25
    WHERE d.n_nationkey <> a.n_nationkey
),
fv1 AS (
    SELECT *,
           scheduled_departure + to_minutes(CAST(60 + 7 * size_ AS BIGINT)) AS scheduled_arrival,
           CASE WHEN status IN ('Arrived', 'Departed')
                THEN scheduled_departure + to_minutes(CAST(key_ % 13 AS BIGINT)) END AS actual_departure
    FROM fv0
),
flights_v AS (
    SELECT flight_id, departure_city, arrival_city, aircraft_code, status,
           scheduled_departure, scheduled_arrival, actual_departure,
           CASE WHEN status = 'Arrived'
                THEN actual_departure + to_minutes(CAST(60 + 7 * size_ + key_ % 7 - 2 AS BIGINT))
           END AS actual_arrival
    FROM fv1
),
flights AS (
    SELECT p_partkey AS flight_id,
           CASE p_size % 10 WHEN 0 THEN 'Cancelled' WHEN 1 THEN 'Scheduled'
                            WHEN 2 THEN 'Departed' ELSE 'Arrived' END AS status
    FROM part
),
airports AS (
    SELECT s.s_suppkey AS airport_code, n.n_name AS city
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
aircrafts AS (
    SELECT aircraft_code, 'Model ' || substr(aircraft_code, 7) AS model
    FROM (SELECT DISTINCT p_brand AS aircraft_code FROM part) b
),
routes AS (SELECT DISTINCT departure_city, arrival_city, aircraft_code FROM flights_v),
seats AS (SELECT DISTINCT p_brand AS aircraft_code, p_size AS seat_no FROM part)
"""

_Q13 = BOUND_PARAMS["q13_unreachable_from_city"]["origin"]
_Q17 = BOUND_PARAMS["q17_destinations_on_day"]
_Q20 = BOUND_PARAMS["q20_avg_departures_per_day"]["origin"]

_HMS = "printf('%02d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60)"

# Each body is a plain SQL statement of its question: named CTEs, joins on
# the raw rows, and extremes as scalar min/max subqueries.
_LEGS = ("tickets t JOIN ticket_flights tf USING (ticket_no) "
         "JOIN flights_v f USING (flight_id)")

BODIES: dict[str, str] = {
    "q01_max_people_per_booking": """
        WITH sizes AS (SELECT book_ref, count(*) AS n FROM tickets GROUP BY book_ref)
        SELECT CAST(1 AS INTEGER) AS id, CAST(max(n) AS VARCHAR) AS response
        FROM sizes HAVING count(*) > 0""",
    "q02_bookings_above_avg_size": """
        WITH sizes AS (SELECT book_ref, count(ticket_no) AS n FROM tickets GROUP BY book_ref)
        SELECT CAST(2 AS INTEGER) AS id,
               CAST(count(*) FILTER (WHERE n > (SELECT avg(n) FROM sizes)) AS VARCHAR) AS response
        FROM sizes""",
    "q03_repeat_names_in_max_bookings": """
        WITH sizes AS (SELECT book_ref, count(*) AS n FROM tickets GROUP BY book_ref),
             biggest AS (SELECT book_ref FROM sizes WHERE n = (SELECT max(n) FROM sizes)),
             repeated AS (SELECT t.book_ref, t.passenger_name
                          FROM tickets t JOIN biggest b ON t.book_ref = b.book_ref
                          GROUP BY t.book_ref, t.passenger_name HAVING count(*) > 1)
        SELECT CAST(3 AS INTEGER) AS id, CAST(count(*) AS VARCHAR) AS response FROM repeated""",
    "q04_contacts_bookings_of_three": """
        WITH of_three AS (SELECT book_ref FROM tickets GROUP BY book_ref HAVING count(*) = 3)
        SELECT CAST(4 AS INTEGER) AS id,
               t.book_ref || '|' || t.passenger_id || '|' || t.passenger_name || '|' || t.contact_data
                   AS response
        FROM tickets t
        WHERE EXISTS (SELECT 1 FROM of_three o WHERE o.book_ref = t.book_ref)""",
    "q05_max_flights_per_booking": f"""
        WITH per_booking AS (SELECT t.book_ref, count(*) AS n FROM {_LEGS} GROUP BY t.book_ref)
        SELECT CAST(5 AS INTEGER) AS id, CAST(max(n) AS VARCHAR) AS response
        FROM per_booking HAVING count(*) > 0""",
    "q05_max_legs_no_flight_check": """
        WITH per_booking AS (SELECT t.book_ref, count(*) AS n
                             FROM tickets t JOIN ticket_flights tf USING (ticket_no)
                             GROUP BY t.book_ref)
        SELECT CAST(5 AS INTEGER) AS id, CAST(max(n) AS VARCHAR) AS response
        FROM per_booking HAVING count(*) > 0""",
    "q06_max_flights_per_ticket": f"""
        WITH per_ticket AS (SELECT t.book_ref, t.ticket_no, count(*) AS n FROM {_LEGS}
                            GROUP BY t.book_ref, t.ticket_no)
        SELECT CAST(6 AS INTEGER) AS id, CAST(max(n) AS VARCHAR) AS response
        FROM per_ticket HAVING count(*) > 0""",
    "q07_max_flights_per_passenger": f"""
        WITH per_passenger AS (SELECT t.passenger_id, count(tf.flight_id) AS n FROM {_LEGS}
                               GROUP BY t.passenger_id)
        SELECT CAST(7 AS INTEGER) AS id, CAST(max(n) AS VARCHAR) AS response
        FROM per_passenger HAVING count(*) > 0""",
    "q08_min_spend_passengers": """
        WITH spend AS (
            SELECT t.passenger_id, t.passenger_name, t.contact_data, sum(tf.amount) AS total
            FROM tickets t JOIN ticket_flights tf USING (ticket_no) JOIN flights f USING (flight_id)
            WHERE f.status <> 'Cancelled'
            GROUP BY t.passenger_id, t.passenger_name, t.contact_data)
        SELECT CAST(8 AS INTEGER) AS id,
               concat(passenger_id, '|', passenger_name, '|', contact_data, '|', CAST(total AS VARCHAR))
                   AS response
        FROM spend WHERE total = (SELECT min(total) FROM spend)""",
    "q09_max_airtime_passengers": f"""
        WITH air AS (
            SELECT t.passenger_id, t.passenger_name, t.contact_data,
                   CAST(sum(date_diff('second', f.actual_departure, f.actual_arrival)) AS BIGINT) AS secs
            FROM {_LEGS}
            WHERE f.status = 'Arrived'
            GROUP BY t.passenger_id, t.passenger_name, t.contact_data)
        SELECT CAST(9 AS INTEGER) AS id,
               passenger_id || '|' || passenger_name || '|' || contact_data || '|' || {_HMS.format(s='secs')}
                   AS response
        FROM air WHERE secs = (SELECT max(secs) FROM air)""",
    "q10_cities_multi_airport": """
        SELECT CAST(10 AS INTEGER) AS id, city AS response
        FROM airports GROUP BY city HAVING count(*) > 1""",
    "q11_fewest_direct_cities": """
        WITH reach AS (SELECT departure_city, count(DISTINCT arrival_city) AS k
                       FROM routes GROUP BY departure_city)
        SELECT CAST(11 AS INTEGER) AS id, departure_city AS response
        FROM reach WHERE k = (SELECT min(k) FROM reach)""",
    "q11_fewest_direct_cities_by_arrival": """
        WITH reach AS (SELECT arrival_city, count(DISTINCT departure_city) AS k
                       FROM routes GROUP BY arrival_city)
        SELECT CAST(11 AS INTEGER) AS id, arrival_city AS response
        FROM reach WHERE k = (SELECT min(k) FROM reach)""",
    "q11_fewest_departures": """
        WITH flown AS (SELECT departure_city, count(*) AS n FROM flights_v GROUP BY departure_city)
        SELECT CAST(11 AS INTEGER) AS id, departure_city AS response
        FROM flown WHERE n = (SELECT min(n) FROM flown)""",
    "q12_unconnected_city_pairs": """
        WITH cities AS (SELECT DISTINCT city FROM airports WHERE city IS NOT NULL),
             pairs AS (SELECT a.city AS c1, b.city AS c2 FROM cities a JOIN cities b ON a.city < b.city)
        SELECT CAST(12 AS INTEGER) AS id, p.c1 || '|' || p.c2 AS response
        FROM pairs p
        WHERE NOT EXISTS (SELECT 1 FROM flights_v f
                          WHERE f.departure_city = p.c1 AND f.arrival_city = p.c2)""",
    "q13_unreachable_from_city": f"""
        WITH cities AS (SELECT DISTINCT city FROM airports WHERE city IS NOT NULL)
        SELECT CAST(13 AS INTEGER) AS id, c.city AS response
        FROM cities c
        WHERE c.city <> '{_Q13}'
          AND EXISTS (SELECT 1 FROM airports WHERE city = '{_Q13}')
          AND NOT EXISTS (SELECT 1 FROM flights_v f
                          WHERE f.departure_city = '{_Q13}' AND f.arrival_city = c.city)""",
    "q14_model_most_flights": """
        WITH arrived AS (SELECT aircraft_code, count(*) AS n FROM flights_v
                         WHERE status = 'Arrived' GROUP BY aircraft_code)
        SELECT CAST(14 AS INTEGER) AS id, a.model AS response
        FROM aircrafts a JOIN arrived r USING (aircraft_code)
        WHERE r.n = (SELECT max(n) FROM arrived)""",
    "q15_model_most_passengers": """
        WITH carried AS (SELECT f.aircraft_code, count(*) AS n
                         FROM ticket_flights tf JOIN flights_v f USING (flight_id)
                         WHERE f.status = 'Arrived' GROUP BY f.aircraft_code)
        SELECT CAST(15 AS INTEGER) AS id, a.model AS response
        FROM aircrafts a JOIN carried c USING (aircraft_code)
        WHERE c.n = (SELECT max(n) FROM carried)""",
    "q16_schedule_deviation_minutes": """
        SELECT CAST(16 AS INTEGER) AS id,
               CAST(abs(sum(date_diff('second', scheduled_departure, scheduled_arrival)
                            - date_diff('second', actual_departure, actual_arrival))) // 60 AS VARCHAR)
                   AS response
        FROM flights_v WHERE status = 'Arrived'""",
    "q17_destinations_on_day": f"""
        SELECT DISTINCT CAST(17 AS INTEGER) AS id, arrival_city AS response
        FROM flights_v
        WHERE departure_city = '{_Q17["origin"]}'
          AND (status = 'Arrived' OR status = 'Departed')
          AND CAST(actual_departure AS DATE) = DATE '{_Q17["on"]}'""",
    "q18_top_revenue_flights": """
        WITH revenue AS (SELECT f.flight_id, sum(tf.amount) AS total
                         FROM ticket_flights tf JOIN flights f USING (flight_id)
                         WHERE f.status <> 'Cancelled' GROUP BY f.flight_id)
        SELECT CAST(18 AS INTEGER) AS id, CAST(flight_id AS VARCHAR) AS response
        FROM revenue WHERE total = (SELECT max(total) FROM revenue)""",
    "q19_quietest_days": """
        WITH per_day AS (SELECT CAST(actual_departure AS DATE) AS d, count(*) AS n
                         FROM flights_v
                         WHERE status <> 'Cancelled' AND actual_departure IS NOT NULL
                         GROUP BY CAST(actual_departure AS DATE))
        SELECT CAST(19 AS INTEGER) AS id, CAST(d AS VARCHAR) AS response
        FROM per_day WHERE n = (SELECT min(n) FROM per_day)""",
    # Europe/Moscow was UTC+3 all year in 2016: its wall clock minus 3 hours is UTC.
    "q19_quietest_days_shifted": """
        WITH per_day AS (SELECT CAST(actual_departure - INTERVAL 3 HOUR AS DATE) AS d, count(*) AS n
                         FROM flights_v
                         WHERE status <> 'Cancelled' AND actual_departure IS NOT NULL
                         GROUP BY CAST(actual_departure - INTERVAL 3 HOUR AS DATE))
        SELECT CAST(19 AS INTEGER) AS id, CAST(d AS VARCHAR) AS response
        FROM per_day WHERE n = (SELECT min(n) FROM per_day)""",
    "q20_avg_departures_per_day": f"""
        SELECT CAST(20 AS INTEGER) AS id, CAST(count(flight_id) // 30 AS VARCHAR) AS response
        FROM flights_v
        WHERE departure_city = '{_Q20}'
          AND (status = 'Departed' OR status = 'Arrived')
          AND CAST(actual_departure AS DATE) BETWEEN DATE '2016-09-01' AND DATE '2016-09-30'""",
    "q21_top5_long_flight_cities": """
        WITH means AS (SELECT departure_city,
                              avg(date_diff('second', actual_departure, actual_arrival)) AS mean_seconds
                       FROM flights_v WHERE status = 'Arrived' GROUP BY departure_city)
        SELECT CAST(21 AS INTEGER) AS id, departure_city AS response
        FROM means WHERE mean_seconds > 10800
        ORDER BY mean_seconds DESC, departure_city ASC NULLS LAST
        LIMIT 5""",
    "el_copy_seats": """
        SELECT aircraft_code, seat_no FROM seats""",
    "el_copy_flights_by_day": """
        SELECT *, CAST(actual_departure AS DATE) AS actual_departure_date FROM flights_v""",
}

BODIES["el_sync_flights_by_day"] = BODIES["el_copy_flights_by_day"]
BODIES["bucketed_airtime"] = BODIES["sql_airtime_passengers"] = BODIES["q09_max_airtime_passengers"]
BODIES["interval_long_flights"] = BODIES["q21_top5_long_flight_cities"]
BODIES |= {
    "rank_top_passengers": f"""
        WITH per_passenger AS (SELECT t.passenger_id, count(*) AS legs FROM {_LEGS} GROUP BY t.passenger_id),
             placed AS (SELECT rank() OVER (ORDER BY legs DESC) AS rank, passenger_id, legs FROM per_passenger)
        SELECT * FROM placed WHERE rank <= 100""",
    "theta_city_pairs": """
        WITH cities AS (SELECT DISTINCT city FROM airports)
        SELECT a.city AS c1, b.city AS c2 FROM cities a JOIN cities b ON a.city < b.city""",
    "band_connecting_flights": """
        SELECT a.flight_id AS first_flight, d.flight_id AS second_flight,
               date_diff('second', a.actual_arrival, d.actual_departure) AS wait_seconds
        FROM flights_v a JOIN flights_v d ON a.arrival_city = d.departure_city
         AND d.actual_departure BETWEEN a.actual_arrival + INTERVAL 30 MINUTE AND a.actual_arrival + INTERVAL 240 MINUTE
        WHERE a.status = 'Arrived' AND d.status IN ('Arrived', 'Departed')""",
    "except_arrival_days": """
        SELECT arrival_city, CAST(actual_arrival AS DATE) AS arrival_day FROM flights_v
        EXCEPT
        SELECT arrival_city, CAST(actual_arrival AS DATE) FROM flights_v WHERE status = 'Departed'""",
}

BODIES["append_answers"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({BODIES[k]}) u{i}" for i, k in enumerate(
        ("q01_max_people_per_booking", "q10_cities_multi_airport", "q01_max_people_per_booking")))

# The mart is the union of the canonical answer of every question id.
_CANONICAL_KEYS = [
    "q01_max_people_per_booking", "q02_bookings_above_avg_size", "q03_repeat_names_in_max_bookings",
    "q04_contacts_bookings_of_three", "q05_max_flights_per_booking", "q06_max_flights_per_ticket",
    "q07_max_flights_per_passenger", "q08_min_spend_passengers", "q09_max_airtime_passengers",
    "q10_cities_multi_airport", "q11_fewest_direct_cities", "q12_unconnected_city_pairs",
    "q13_unreachable_from_city", "q14_model_most_flights", "q15_model_most_passengers",
    "q16_schedule_deviation_minutes", "q17_destinations_on_day", "q18_top_revenue_flights",
    "q19_quietest_days", "q20_avg_departures_per_day", "q21_top5_long_flight_cities",
]
BODIES["mart_results"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({BODIES[k]}) u{i}" for i, k in enumerate(_CANONICAL_KEYS)
)


def oracle_sql() -> dict[str, str]:
    return {key: f"{BINDING}\nSELECT * FROM ({body}\n) AS answer" for key, body in BODIES.items()}
