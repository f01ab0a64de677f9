"""reverbkit.functions"""
