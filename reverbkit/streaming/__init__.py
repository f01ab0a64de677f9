"""reverbkit.streaming"""
