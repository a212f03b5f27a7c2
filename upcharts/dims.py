"""Small fixed dimensions: genre allowlist, manual overrides, genre families."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Genres that count as a genre; every other tag is dropped.
GENRE_ALLOWLIST = (
    "pop", "rock", "pop rock", "r&b", "country", "standards", "adult contemporary",
    "blues rock", "folk rock", "soft rock", "roots rock", "singer-songwriter",
    "folk pop", "country pop", "hip hop", "contemporary r&b", "new jack swing",
    "power pop", "pop punk", "soul", "jazz", "dance-pop", "big band",
    "traditional pop", "vocal jazz", "contemporary country", "trap", "blues",
    "alternative r&b", "pop rap", "swing", "alternative pop", "funk", "rap",
    "southern hip hop", "alternative rock", "dance", "trap soul", "electronic",
    "hardcore hip hop", "synth-pop", "folk", "americana", "easy listening",
    "bluegrass", "nashville sound", "hip hop soul", "hip-hop", "trap rap",
    "indie pop", "alternative", "alternative/indie rock", "indie rock",
    "psychedelic pop", "psychedelic rock", "disco", "electropop", "pop soul",
    "singer/songwriter", "adult standards", "folk music", "classical",
    "orchestral", "k-pop", "latin", "avant-garde", "avant-garde jazz",
    "dixieland", "free jazz", "hard bop", "modern creative", "post-bop",
    "progressive jazz", "saxophone jazz",
)

# Primary artists whose automatic match is known to be wrong.
# Their tags are replaced by the given list (no verified genre).
MANUAL_OVERRIDES = {
    "Junior H": [],
    "Julia Wolf": [],
    "George Birge": [],
    "J. Cole": [],
    "Olivia Dean": [],
    "John": [],
    "John Morgan": [],
    "Josiah Queen": [],
    "Leon Thomas": [],
    "Ella Langley": [],
    "Steve Lacy": [],
    "Jordan Davis": [],
    "Dylan Scott": [],
    "Rod Wave": [],
}

# Genre family -> member genres.
GENRE_FAMILIES = {
    "Folk/Singer-songwriter": (
        "folk", "folk pop", "folk rock", "singer-songwriter", "singer/songwriter",
        "americana", "bluegrass",
    ),
    "Country/Americana": (
        "country", "country pop", "contemporary country", "nashville sound",
    ),
    "Rock/Alternative": (
        "rock", "alternative rock", "alternative", "alternative/indie rock",
        "indie rock", "indie pop", "psychedelic rock", "psychedelic pop",
        "blues rock", "soft rock", "roots rock", "power pop", "pop punk",
    ),
    "R&B/Soul": (
        "r&b", "contemporary r&b", "alternative r&b", "soul", "hip hop soul",
        "funk", "disco",
    ),
    "Pop (core)": (
        "pop", "pop rock", "dance-pop", "synth-pop", "electropop", "pop soul",
        "pop rap",
    ),
    "Dance/Electronic": ("electronic", "dance", "trap soul"),
    "HipHop/Rap": (
        "hip hop", "hip-hop", "trap", "trap rap", "rap", "southern hip hop",
        "hardcore hip hop",
    ),
}


def override_frame(spark: SparkSession, overrides: dict[str, list[str]] | None = None) -> DataFrame:
    """Overrides as a local relation, so Catalyst knows its size."""
    overrides = MANUAL_OVERRIDES if overrides is None else overrides
    return spark.createDataFrame(
        pa.table(
            {
                "primary_artist_used": pa.array(list(overrides), pa.string()),
                "override_tags": pa.array(list(overrides.values()), pa.list_(pa.string())),
            }
        )
    )
