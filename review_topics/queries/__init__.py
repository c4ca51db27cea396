"""Queries over the test tables, one per operator, each with the SQL it must agree with where SQL can say it."""

from review_topics.queries import review_queries, topic_queries
from review_topics.queries.common import ORACLES, QUERIES, forget_stages

flagship = topic_queries.flagship
__all__ = ["ORACLES", "QUERIES", "flagship", "forget_stages", "review_queries", "topic_queries"]
