"""Composite queries: staging, monthly measures, dimensions, fact, marts, exports, serving."""
