"""reverbkit.plans"""
