from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and codes shown to users.
UNDER_20 = "20岁及以下"
OVER_30 = "30岁及以上"
BETWEEN_20_AND_30 = "在20岁和30岁之间"
MALE_CODE = "M"
MALE = "男"
FEMALE = "女"
YEAR_MS = 365 * 24 * 60 * 60 * 1000


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole 365-day years from a `yyyy-MM-dd` birthday to `as_of` (a timestamp)."""
    born = F.unix_millis(birthday.try_cast("date").cast("timestamp"))
    return F.call_function("div", F.unix_millis(as_of) - born, F.lit(YEAR_MS))


def age_group(age: Column) -> Column:
    """Label of an age; 20 and 30 themselves are in the middle group."""
    return (
        F.when(age < 20, UNDER_20)
        .when(age > 30, OVER_30)
        .when(age.isNotNull(), BETWEEN_20_AND_30)
    )


def gender_name(gender: Column) -> Column:
    """Male for the male code; anything else, null included, is female."""
    return F.when(gender == MALE_CODE, MALE).otherwise(FEMALE)
