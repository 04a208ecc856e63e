"""Reading and writing the batch's files and tables."""

from tracklens.sources.frequent import known_heavy_keys, note_heavy_keys
from tracklens.sources.readers import (
    read_logs,
    read_metrics_csv,
    read_metrics_src_csv,
    read_results_quarantine,
    read_table,
    read_track_id_list,
    read_work_list,
)
from tracklens.sources.versions import (
    buckets_of,
    recover,
    replace_by_version,
    switch_version,
    version_tag,
    write_version,
)
from tracklens.sources.writers import (
    append_by_name,
    append_positional,
    create_metrics_src_table,
    create_table_as,
    ensure_metrics_table,
    materialize,
    replace_via_staging,
    truncate_insert,
    write_bucketed,
    write_daily,
    write_single_csv,
)

__all__ = [name for name in dir() if not name.startswith("_")]
