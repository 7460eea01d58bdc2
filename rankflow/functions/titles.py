"""Features read out of a person's name and family counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The honorific sits between the last ", " and the next "."; each known one
# belongs to a group.
TITLE_PATTERN = r"^.*, (.*?)\..*\z"
TITLE_GROUPS = {
    "Mrs": "Mrs",
    "Lady": "Mrs",
    "Mme": "Mrs",
    "Ms": "Ms",
    "Miss": "Miss",
    "Mlle": "Miss",
    "Master": "Master",
    "Rev": "Rev",
    "Don": "Mr",
    "Sir": "Sir",
    "Dr": "Dr",
    "Col": "Col",
    "Capt": "Col",
    "Major": "Col",
}


def regex_lookup(
    text: Column,
    pattern: str,
    mapping: Mapping[str, str],
    unmapped: Column,
    unmatched: Column,
    group: int = 1,
) -> Column:
    """Capture a token, look it up, and default separately for unknown tokens and for no match.

    ``rlike`` decides the match because ``regexp_extract`` gives ``''`` both for no match and
    for an empty capture.
    """
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    known = F.try_element_at(F.create_map(*entries), F.regexp_extract(text, pattern, group))
    return F.when(text.rlike(pattern), F.coalesce(known, unmapped)).otherwise(unmatched)


def passenger_title(name: Column | str, sex: Column | str) -> Column:
    name = F.col(name) if isinstance(name, str) else name
    sex = F.col(sex) if isinstance(sex, str) else sex
    by_sex = F.when(sex == "male", "Mr").otherwise("Mrs")
    return regex_lookup(name, TITLE_PATTERN, TITLE_GROUPS, by_sex, F.lit("Mr"))


def family_size(siblings: Column | str, parents: Column | str) -> Column:
    """Siblings and spouses, parents and children, and the person."""
    siblings = F.col(siblings) if isinstance(siblings, str) else siblings
    parents = F.col(parents) if isinstance(parents, str) else parents
    return siblings + parents + 1
