"""Record layouts of the input files."""

from __future__ import annotations

# Column names and types of the input files.
PAGE_POSTS = """
    req_time timestamp, user_id string, machine_cookie string, session_cookie string, user_agent string,
    referrer string, url string, url_params string, machine_ip string, page_key string, page_type string,
    referrer_key string, px_score string, other string
"""
SOURCE_EVENTS = """
    req_time timestamp, source string, type string, action string, machine_ip string, page_key string, data string
"""
RAW_POSTS = """
    req_time string, machine_ip string, px_score string, user_agent string, version string, page_type string,
    page_key string, referrer_key string, referrer string, event_name string, url string, url_params string,
    machine_cookie string, session_cookie string, user_id string, user_email string, user_vocation string,
    other string
"""
REGISTRATIONS = """
    user_id bigint, email string, email_domain string, registration_date date, registration_hour int,
    confirmation_date date, is_confirmed int, user_agent string, is_gplus bigint, page_type string,
    client_id string
"""
FRAUD_PAGE_VIEWS = """
    ts timestamp, event_name string, machine_cookie string, session_cookie string, page_key string, user_id int,
    user_agent string, referrer string, referrer_domain string, url string, content_id int, machine_ip string,
    client_type string, country_geo string, territory_geo string
"""
PAGE_TIMING = """
    ts timestamp, user_id int, page_type string, first_page_event timestamp, last_page_event timestamp,
    page_key string, block_start int
"""
MAIL_READERS = "user_id string, year int, created_at timestamp, last_seen date"
USER_AGENTS = "user_agent string"
GEO_RECORD = """
    countryCode string, countryName string, region string, city string, postalCode string, continent string,
    regionCode string, timezone string
"""

# Positions of (user_id, email, ts) in the headerless logs, by first and last year.
LOG_LAYOUTS = [
    (None, 2014, {"user_id": 36, "email": 38, "ts": 1}),
    (2015, 2017, {"user_id": 32, "email": 34, "ts": 1}),
    (2018, 2018, {"user_id": 27, "email": 28, "ts": 2}),
]


def log_layout(year: int) -> dict[str, int]:
    """Column positions of a year's log; an error for years nobody described."""
    for first, last, layout in LOG_LAYOUTS:
        if (first is None or first <= year) and year <= last:
            return layout
    raise ValueError(f"no log layout is known for {year}")
