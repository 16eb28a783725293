"""Error types.  Loads raise these; nothing is swallowed or printed."""


class ContractError(ValueError):
    """A declared contract is wrong, unknown, or does not fit the data's columns."""


class LoadError(RuntimeError):
    """A load cannot finish with a whole and correct result."""
