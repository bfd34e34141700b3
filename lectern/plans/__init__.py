"""Input views, registered queries and their oracle SQL."""
