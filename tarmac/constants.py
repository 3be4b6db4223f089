"""Fixed values of the bookings domain.

FIXED VALUES — these must equal the source system's values for the answers
to be right. They are stated plainly, in natural order, in one place.
"""

# Flight status values named by the questions.
STATUS_CANCELLED = "Cancelled"
STATUS_ARRIVED = "Arrived"
STATUS_DEPARTED = "Departed"

# Default city parameters of the questions that name a city.
CITY_MOSCOW = "Москва"
CITY_ST_PETERSBURG = "Санкт-Петербург"

# Question 17: the day asked about.
Q17_DAY = "2016-09-13"

# Question 20: the month asked about, as an inclusive day range.
Q20_FIRST_DAY = "2016-09-01"
Q20_LAST_DAY = "2016-09-30"

# Question 19 shifted form: the zone the clock is shifted from.
Q19_SOURCE_ZONE = "Europe/Moscow"

# Question 21: mean flight time must be strictly above this many seconds (3 h),
# and at most this many cities are reported.
Q21_MIN_MEAN_SECONDS = 10800
Q21_TOP_N = 5

# Question 4: the booking size asked about.
Q04_BOOKING_SIZE = 3

# Separator used inside a response string.
RESPONSE_SEPARATOR = "|"

# Results mart: table schema is (id INT, response STRING).
RESULTS_TABLE = "results"
