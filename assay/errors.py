"""Exceptions raised by the library."""


class AssayError(Exception):
    """Base class of every error raised here."""


class BadParameter(AssayError, ValueError):
    """A job parameter (date, project, rule argument) is malformed."""


class SchemaDriftError(AssayError):
    """A source or batch does not have the columns / types the job needs."""


class SessionConfigError(AssayError):
    """The Spark session is configured in a way that changes results."""


class SuiteNotFound(AssayError, LookupError):
    """A rule suite was loaded by name but none is stored."""


class CheckpointFailed(AssayError):
    """More rules failed than the gate allows."""

    def __init__(self, failed: int, allowed: int, run_name: str | None = None,
                 failures: list[dict] | None = None):
        self.failed = failed
        self.allowed = allowed
        self.run_name = run_name
        self.failures = failures or []  # the failed rules' result rows, for listing
        where = f" in run {run_name}" if run_name else ""
        super().__init__(
            f"gate closed{where}: {failed} rules failed, the limit is {allowed}"
        )
