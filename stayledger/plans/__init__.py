"""Composed jobs: bookings to silver, silver to gold, star schema, measures."""
