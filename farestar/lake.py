"""Named storage roots and table locations of the three layers."""

from __future__ import annotations

from dataclasses import dataclass

# Folder and file names of the published data set and of the tables built on it.
TRIP_DATASET = "yellow_tripdata"
SOURCE_FOLDER = "trip-data"
SILVER_TRIPS = "yellow_taxi_cleaned"
DIM_DATE = "dim_date"
DIM_PAYMENT_TYPE = "dim_payment_type"
FACT_TRIPS = "fact_trips"
FACT_CORRECTIONS = "fact_corrections"
# Prefix of a month that is being replaced by a new copy.
REPLACED = "_replaced-"


@dataclass(frozen=True)
class Lake:
    """Paths of one lake; ``root`` is any URI that Spark can read and write.

    ``bronze``, ``silver`` and ``gold`` may be set apart when the layers live in different
    containers or buckets.
    """

    root: str
    bronze: str | None = None
    silver: str | None = None
    gold: str | None = None

    def layer(self, name: str) -> str:
        return (getattr(self, name) or f"{self.root.rstrip('/')}/{name}").rstrip("/")

    @property
    def trips_glob(self) -> str:
        """Every raw month, any year: a file or a folder of part files."""
        return f"{self.layer('bronze')}/{TRIP_DATASET}/*/*.parquet"

    @property
    def replaced_glob(self) -> str:
        """Months that a cut-short landing has put aside."""
        return f"{self.layer('bronze')}/{TRIP_DATASET}/*/{REPLACED}*"

    @property
    def schemas(self) -> str:
        """The recorded schemas of the landed months."""
        return f"{self.layer('bronze')}/{TRIP_DATASET}_schemas"

    def month_path(self, year: int | str, month: str) -> str:
        return f"{self.layer('bronze')}/{TRIP_DATASET}/{year}/{month_file(year, month)}"

    @property
    def silver_trips(self) -> str:
        return f"{self.layer('silver')}/{SILVER_TRIPS}"

    def gold_table(self, name: str) -> str:
        return f"{self.layer('gold')}/{name}"


def month_file(year: int | str, month: str) -> str:
    return f"{TRIP_DATASET}_{year}-{month}.parquet"


def source_path(base: str, year: int | str, month: str) -> str:
    return f"{base.rstrip('/')}/{SOURCE_FOLDER}/{month_file(year, month)}"
