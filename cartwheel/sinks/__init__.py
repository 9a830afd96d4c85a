"""Writers, incremental refresh and table upkeep."""
