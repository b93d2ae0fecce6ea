"""Table operators: each is ``DataFrame(s) + parameters -> DataFrame``."""
