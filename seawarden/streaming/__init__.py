"""The batch operators applied to a stream of position reports."""
