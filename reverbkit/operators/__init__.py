"""reverbkit.operators"""
