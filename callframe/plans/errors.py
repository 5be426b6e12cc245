"""The three error kinds of the reference: bad schema, failed job step,
diverged training run."""


class SchemaValidationError(Exception):
    """Input rows do not form records (first-row precheck, on_error='fail')."""


class PipelineError(Exception):
    """A job step cannot run (missing input, empty split)."""


class DivergenceError(Exception):
    """A training log holds a non-finite loss."""
