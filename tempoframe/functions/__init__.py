"""Part of the event and valuation engine."""
