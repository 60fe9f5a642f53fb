from .tables import (  # noqa: F401
    load_model, load_record, load_split, read_features, read_sensor_csv, read_table,
    save_model, save_record, save_split, write_features, write_report, write_table,
)
