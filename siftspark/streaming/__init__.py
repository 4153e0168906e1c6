from siftspark.streaming.files import (
    kept_schema,
    stream_files,
    stream_inferred,
    stream_raw,
    stream_to_bronze,
)

__all__ = ["kept_schema", "stream_files", "stream_inferred", "stream_raw", "stream_to_bronze"]
