"""Pure DataFrame -> DataFrame operators. None of them runs a job by itself."""
