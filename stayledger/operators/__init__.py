"""Frame to frame operators, made to be chained with ``DataFrame.transform``."""
