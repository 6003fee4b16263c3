"""The driver's tables as a mixed event feed, the registered queries, and their SQL counterparts."""
