"""Models, serving queries, exports and quality rules as DataFrame plans."""
