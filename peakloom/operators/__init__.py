"""DataFrame operators; every one takes and returns lazy DataFrames unless it says otherwise."""
