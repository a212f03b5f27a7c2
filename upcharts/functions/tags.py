"""Genre tag expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from upcharts.dims import GENRE_ALLOWLIST, GENRE_FAMILIES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def no_tags() -> Column:
    return F.array().cast("array<string>")


def allowed_tags(tags: Column | str, allowlist: Sequence[str] = GENRE_ALLOWLIST) -> Column:
    """Tags in the allowlist; order and duplicates are kept."""
    return F.filter(_col(tags), lambda tag: tag.isin(*allowlist))


def genre_family(genre: Column | str) -> Column:
    """Family of a genre, NULL where no family claims it."""
    genre = _col(genre)
    return F.coalesce(
        *[F.when(genre.isin(*members), F.lit(family)) for family, members in GENRE_FAMILIES.items()]
    )
