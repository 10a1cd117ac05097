"""End-to-end plans: the query registry, the game-outcome model pipeline."""
