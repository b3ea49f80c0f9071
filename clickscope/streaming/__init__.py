"""Structured Streaming form of the ad-click job."""
