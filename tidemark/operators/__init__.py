"""DataFrame -> DataFrame operators; none of them starts a job."""
