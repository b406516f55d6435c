"""Recency buckets used by the expiry and posting views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_of

# Expiry labels, in rule order.
EXPIRED = "Expired"
EXPIRES_TODAY = "Expires Today"
EXPIRES_VERY_SOON = "Expires Very Soon (1-3 days)"
EXPIRES_SOON = "Expires Soon (4-7 days)"
EXPIRES_1_2_WEEKS = "Expires in 1-2 weeks"
MORE_THAN_2_WEEKS = "More than 2 weeks left"

# Posting labels, in rule order (the third one has two spaces before '-').
POSTED_TODAY = "Be an early applicant - posted Today!"
POSTED_1_3_DAYS = "Be an early applicant - only 1-3 days old!"
POSTED_WEEK = "Get in now  - less than a week old!"
POSTED_2_WEEKS = "Been over a week now - get your skates on!"
POSTED_OLDER = "More than 2 weeks old - what are you waiting for?"


def expiry_bucket(days_left: Column | str) -> Column:
    d = col_of(days_left)
    return (
        F.when(d < 0, EXPIRED)
        .when(d == 0, EXPIRES_TODAY)
        .when(d <= 3, EXPIRES_VERY_SOON)
        .when(d <= 7, EXPIRES_SOON)
        .when(d <= 14, EXPIRES_1_2_WEEKS)
        .otherwise(MORE_THAN_2_WEEKS)
    )


def posting_bucket(days_since_posted: Column | str) -> Column:
    d = col_of(days_since_posted)
    return (
        F.when(d < 1, POSTED_TODAY)
        .when(d <= 3, POSTED_1_3_DAYS)
        .when(d <= 7, POSTED_WEEK)
        .when(d <= 14, POSTED_2_WEEKS)
        .otherwise(POSTED_OLDER)
    )
