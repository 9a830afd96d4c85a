"""Commerce lakehouse engine: DataFrame plans for change feeds, click events, FX rates and marts."""
