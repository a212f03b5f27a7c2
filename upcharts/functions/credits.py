"""Lead-artist extraction from a credit string, as one native column expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separator characters.
_SPACE = r"[\s\x1c-\x1f]"

# Separators between lead artist and collaborators, tried in this
# order; each must be surrounded by white space (the comma: followed by it).
SEPARATORS = ("Featuring", r"Feat\.", r"feat\.", "With", "&", "[xX]", ",")


def primary_artist(credit: Column | str) -> Column:
    """Text before the first hit of each separator, in order, then stripped.

    Case-sensitive. The result may be an empty string (``" & Foo"``).
    """
    lead = F.col(credit) if isinstance(credit, str) else credit
    for separator in SEPARATORS:
        gap = "" if separator == "," else f"{_SPACE}+"
        lead = F.split(lead, f"(?U){gap}{separator}{_SPACE}+", 2)[0]
    return F.regexp_replace(lead, f"(?U)^{_SPACE}+|{_SPACE}+$", "")
