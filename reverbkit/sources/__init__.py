"""reverbkit.sources"""
