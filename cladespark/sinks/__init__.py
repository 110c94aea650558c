"""Writers of profiles and side tables."""
