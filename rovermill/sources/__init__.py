"""Readers of ride folders: CSV streams, playlists, manifests, binary files."""
