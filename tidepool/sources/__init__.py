from tidepool.sources.files import (  # noqa: F401
    TABLES,
    read_csv,
    read_jdbc,
    read_json,
    read_orc,
    read_partitioned,
    read_table,
    read_text,
    sql_on_files,
    table_path,
)
from tidepool.sources.sinks import (  # noqa: F401
    to_pandas,
    write_csv,
    write_parquet,
)
