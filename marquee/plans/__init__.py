"""Multi-step jobs and the registered queries."""
