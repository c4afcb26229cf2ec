from datetime import date, timedelta

CLICK_SCHEMA = (
    "country string, website_name string, action string, zone string, date string, clicks int, "
    "master_user_group_id bigint, ip_address_user_agent string, city_code string, "
    "company_name string, domain_name string"
)


def days(last, count):
    """The count dates that end with last, oldest first."""
    end = date.fromisoformat(last)
    return [(end - timedelta(days=n)).isoformat() for n in reversed(range(count))]


def click(country, day, website="w", user=1, clicks=1, action="a", zone="z"):
    person = f"p{user}"
    return (country, website, action, zone, day, clicks, user, person, "c", person, f"d{user}")


def clicks_on(country, per_day, **more):
    """One row per click; per_day maps a date to its number of clicks."""
    return [click(country, d, user=n, **more) for d, k in per_day.items() for n in range(k)]


def layer(spark, rows):
    return spark.createDataFrame(rows, CLICK_SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
