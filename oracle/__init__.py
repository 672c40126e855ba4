"""DuckDB SQL for every registered query, on the same Parquet tables."""

from oracle import bars, hotel, ingest, logs


def all_sql() -> dict[str, str]:
    return {**bars.SQL, **hotel.SQL, **ingest.SQL, **logs.SQL}
