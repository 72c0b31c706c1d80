"""Models (staging, latest, marts) and the registered query catalogue."""
