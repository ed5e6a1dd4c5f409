"""The published result tables, each as a function of the warehouse inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from tidemark.operators import events, issues, partials, profiles, rankings
from tidemark.operators.dims import latest_snapshot
from tidemark.operators.hours import stamp_hour, within_hour


@dataclass(frozen=True)
class Inputs:
    """Frames the result tables are computed from.

    ``users`` and ``repos`` keep every snapshot, and the order columns rank the
    snapshots of one id; with an order of None they hold current rows only,
    and so do the ``issues``.
    ``hour`` is a one-row frame, see ``operators.hours``.
    ``unique_events`` says that no event occurs twice in ``activity``; ``date``
    names the column its files are partitioned by, if they are.
    ``hours, actors, repo_events`` are partial counts of the activity, see
    ``operators.partials``; with them no result over all history reads an event.
    """

    activity: DataFrame
    issues: DataFrame
    users: DataFrame
    repos: DataFrame
    hour: DataFrame
    user_order: rankings.Order = ("updated_at",)
    repo_order: rankings.Order = ("updated_at",)
    issue_order: rankings.Order = None
    unique_events: bool = False
    date: str | None = None
    hours: DataFrame | None = None
    actors: DataFrame | None = None
    repo_events: DataFrame | None = None

    @cached_property
    def current_users(self) -> DataFrame:
        return self.users if self.user_order is None else latest_snapshot(self.users, self.user_order)

    @cached_property
    def current_issues(self) -> DataFrame:
        return self.issues if self.issue_order is None else issues.current_issues(self.issues, self.issue_order)

    @cached_property
    def pushes(self) -> DataFrame:
        return self.activity.where(within_hour(self.hour, date=self.date))

    def user_activity(self) -> DataFrame:
        return rankings.activity_per(self.pushes, "actor_id", unique=self.unique_events)

    def repo_activity(self) -> DataFrame:
        return rankings.activity_per(self.pushes, "repo_id", unique=self.unique_events)


def _event_all_count(i: Inputs) -> DataFrame:
    return events.event_all_count(i.activity, i.hour) if i.hours is None else partials.all_count(i.hours, i.hour)


def _event_count(i: Inputs) -> DataFrame:
    return events.event_count(i.activity, i.hour, i.date) if i.hours is None else partials.hour_count(i.hours, i.hour)


def _counts(i: Inputs, key: str) -> DataFrame:
    stored = i.actors if key == "actor_id" else i.repo_events
    return events.count_by(i.activity, key) if stored is None else partials.counts_per(stored, key)


def _event_all_ratio(i: Inputs) -> DataFrame:
    return events.event_ratio(_event_all_count(i))


def _event_ratio(i: Inputs) -> DataFrame:
    return events.event_ratio(_event_count(i))


def _top_active_user(i: Inputs) -> DataFrame:
    return stamp_hour(rankings.active_users(i.user_activity(), i.users, i.user_order), i.hour)


def _top_active_repo(i: Inputs) -> DataFrame:
    return stamp_hour(rankings.active_repos(i.repo_activity(), i.repos, i.repo_order), i.hour)


def _top_language(i: Inputs) -> DataFrame:
    return stamp_hour(rankings.active_languages(i.repo_activity(), i.repos, i.repo_order), i.hour)


# Names of the published tables.
RESULTS: dict[str, Callable[[Inputs], DataFrame]] = {
    "eventAllCount": _event_all_count,
    "eventCount": _event_count,
    "eventAllRatio": _event_all_ratio,
    "eventRatio": _event_ratio,
    "usersCount": lambda i: events.dim_count(i.users, "usersCount"),
    "reposCount": lambda i: events.dim_count(i.repos, "reposCount"),
    "issueBasic": lambda i: issues.issue_basic(i.issues, i.hour),
    "issueInterval": lambda i: issues.issue_interval_hist(i.issues, i.hour),
    "issueComments": lambda i: issues.issue_comments_hist(i.issues, i.hour),
    "issueNumber": lambda i: issues.issue_number_hist(i.issues, i.hour),
    "userBasic": lambda i: profiles.profile_ratios(i.current_users, i.hour),
    "top20_followers": lambda i: profiles.top_users(i.current_users, "followers"),
    "top20_following": lambda i: profiles.top_users(i.current_users, "following"),
    "topActiveUser": _top_active_user,
    "topActiveRegion": lambda i: rankings.active_regions(i.user_activity(), i.users, i.user_order),
    "topActiveCompany": lambda i: rankings.active_companies(i.user_activity(), i.users, i.user_order),
    "topActiveRepo": _top_active_repo,
    "topLanguage": _top_language,
}

# The dashboard's further tables: the trend, counts per user and repository, all-time and last-minutes rankings.
def _recent_users(i: Inputs) -> DataFrame:
    return rankings.activity_per(events.recent(i.activity, 10, i.hour, i.date), "actor_id", unique=i.unique_events)


def _all_users(i: Inputs) -> DataFrame:
    if i.actors is not None:
        return partials.counts_per(i.actors, "actor_id", (rankings.PUSH,), "id")
    return rankings.activity_per(i.activity, "actor_id", unique=i.unique_events)


RESULTS |= {
    "eventTrend": lambda i: events.event_trend(i.activity) if i.hours is None else partials.trend(i.hours),
    "userEvents": lambda i: _counts(i, "actor_id"),
    "userEventsRecent": lambda i: events.count_by(events.recent(i.activity, 20, i.hour, i.date), "actor_id"),
    "repoEvents": lambda i: _counts(i, "repo_id"),
    "repoEventsRecent": lambda i: events.count_by(events.recent(i.activity, 20, i.hour, i.date), "repo_id"),
    "topRegionAllTime": lambda i: rankings.active_regions(_all_users(i), i.users, i.user_order),
    "topCompanyAllTime": lambda i: rankings.active_companies(_all_users(i), i.users, i.user_order),
    "topRegionRecent": lambda i: rankings.active_regions(_recent_users(i), i.users, i.user_order),
    "topCompanyRecent": lambda i: rankings.active_companies(_recent_users(i), i.users, i.user_order),
}

# The issue tables over the current state of every issue.
RESULTS |= {
    "issueBasicCurrent": lambda i: issues.issue_basic(i.current_issues, i.hour),
    "issueIntervalCurrent": lambda i: issues.issue_interval_hist(i.current_issues, i.hour),
    "issueCommentsCurrent": lambda i: issues.issue_comments_hist(i.current_issues, i.hour),
    "issueNumberCurrent": lambda i: issues.issue_number_hist(i.current_issues, i.hour),
}

# Dimension columns the tables above need.
CURRENT_USER = ("login", *profiles.TEXT_FIELDS, *profiles.NUMBER_FIELDS)
CURRENT_REPO = rankings.REPO_COLUMNS

# The tables each analysis job publishes.
JOBS = {
    "events": ("eventAllCount", "eventCount", "eventAllRatio", "eventRatio", "usersCount", "reposCount"),
    "issues": ("issueBasic", "issueInterval", "issueComments", "issueNumber"),
    "current_issues": ("issueBasicCurrent", "issueIntervalCurrent", "issueCommentsCurrent", "issueNumberCurrent"),
    "users": ("userBasic", "top20_followers", "top20_following"),
    "user_activity": ("topActiveUser", "topActiveRegion", "topActiveCompany"),
    "repo_activity": ("topActiveRepo", "topLanguage"),
    "dashboard": ("eventTrend", "userEvents", "userEventsRecent", "repoEvents", "repoEventsRecent"),
    "dashboard_rankings": ("topRegionAllTime", "topCompanyAllTime", "topRegionRecent", "topCompanyRecent"),
}
