"""DataFrame operators of the selection and batching job."""
