"""Writers: idempotent period overwrite, upsert by partition, bucketed and partitioned layouts."""
