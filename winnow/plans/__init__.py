"""Query plans over the driver's tables: each is (spark, sf_dir) -> DataFrame,
registered with an equivalent DuckDB SQL oracle where one exists."""


def load_all() -> None:
    """Import every plan module so its queries register."""
    import importlib

    for m in ("selection", "jsongate", "vectors", "lifecycle", "export", "records", "store_ops", "text", "reports", "streaming", "runs"):
        importlib.import_module(f"{__name__}.{m}")
