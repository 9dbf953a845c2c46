"""Chat templates by name (fixed values of the public chat formats).

``(name,)`` in a slot is a special token. ``kind`` is ``plain`` if not given; ``bare`` has no separator and cuts the longer side
first, ``folded`` puts the system text into the first question, ``reasoning`` handles thoughts.
"""

from __future__ import annotations

_IM_USER = "<|im_start|>user\n{{content}}<|im_end|>\n<|im_start|>assistant\n"
_IM_SYSTEM = "<|im_start|>system\n{{content}}<|im_end|>\n"
_IM_TOOL = "<|im_start|>tool\n{{content}}<|im_end|>\n<|im_start|>assistant\n"
_IM_RESULT = "<|im_start|>user\n<tool_response>\n{{content}}\n</tool_response><|im_end|>\n<|im_start|>assistant\n"
_IM_ANSWER = "{{content}}<|im_end|>\n"
_BOS, _EOS = ("bos",), ("eos",)
_GLM = {"user": ["<|user|>\n{{content}}<|assistant|>"], "assistant": ["\n{{content}}"], "system": ["<|system|>\n{{content}}"], "function": ["{{name}}\n{{arguments}}"], "observation": ["<|observation|>\n{{content}}<|assistant|>"], "prefix": ["[gMASK]<sop>"], "stop_words": ("<|user|>", "<|observation|>"), "efficient_eos": True}
_GLM3 = {"user": [("<|user|>",), "\n", "{{content}}", ("<|assistant|>",)], "assistant": ["\n", "{{content}}"], "observation": [("<|observation|>",), "\n", "{{content}}", ("<|assistant|>",)], "stop_words": ("<|user|>", "<|observation|>"), "efficient_eos": True}
_CHATML = {"user": [_IM_USER], "system": [_IM_SYSTEM], "observation": [_IM_TOOL], "separator": ["\n"], "replace_eos": True}
_COLON = {"user": ["User: {{content}}\n\nAssistant:"], "system": ["{{content}}\n\n"], "prefix": [_BOS]}
_INST = {"user": ["[INST] {{content}} [/INST]"], "prefix": [_BOS]}

TEMPLATES: dict[str, dict] = {
    "bytes": {"user": [("user",), "{{content}}", ("assistant",)], "system": [("system",), "{{content}}"], "prefix": [_BOS], "kind": "bare"},
    "chatglm2": {"user": ["[Round {{idx}}]\n\n问：{{content}}\n\n答："], "prefix": [("[gMASK]",), ("sop",)], "separator": ["\n\n"], "efficient_eos": True},
    "chatglm3": _GLM3 | {"system": [("<|system|>",), "\n", "{{content}}"], "prefix": [("[gMASK]",), ("sop",)]},
    "chatglm3_system": _GLM3 | {"system": [("[gMASK]",), ("sop",), ("<|system|>",), "\n", "{{content}}"], "function": ["{{name}}\n{{arguments}}"], "default_system": "You are ChatGLM3, a large language model trained by Zhipu.AI. Follow the user's instructions carefully. Respond using markdown."},
    "glm4": _GLM,
    "glm4_moe": _GLM | {"kind": "reasoning"},
    "chatml": _CHATML | {"stop_words": ("<|im_end|>", "<|im_start|>")},
    "chatml_de": _CHATML | {"stop_words": ("<|im_end|>", "<|im_start|>"), "default_system": "Du bist ein freundlicher und hilfsbereiter KI-Assistent."},
    "cpm": {"user": ["<用户>{{content}}<AI>"], "prefix": [_BOS]},
    "default": {"user": ["Human: {{content}}\nAssistant:"], "system": ["{{content}}\n"], "separator": ["\n"]},
    "empty": {"user": ["{{content}}"], "assistant": ["{{content}}"]},
    "trl": {"user": ["{{content}}"], "assistant": ["{{content}}"], "prefix": [_BOS]},
    "qwen_lf": {"user": [_IM_USER], "assistant": [_IM_ANSWER], "system": [_IM_SYSTEM], "observation": [_IM_RESULT], "separator": ["\n"], "default_system": "You are Qwen, created by Alibaba Cloud. You are a helpful assistant.", "stop_words": ("<|im_end|>",), "replace_eos": True, "kind": "bare"},
    "qwen": _CHATML | {"default_system": "You are a helpful assistant.", "stop_words": ("<|im_end|>",)},
    "qwen_r1": _CHATML | {"user": ["<|im_start|>user\nA conversation between User and Assistant. The user asks a question, and the Assistant solves it. The assistant first thinks about the reasoning process in the mind and then provides the user with the answer. The reasoning process and answer are enclosed within <think> </think> and <answer> </answer> tags, respectively, i.e., <think> reasoning process here </think><answer> answer here </answer>Put your final answer within \\\\boxed{}. {{content}}<|im_end|>\n<|im_start|>assistant\n"], "default_system": "You are a helpful assistant.", "stop_words": ("<|im_end|>",)},
    "qwen_math_r1": _CHATML | {"default_system": "Please reason step by step, and put your final answer within \\boxed{}.", "stop_words": ("<|im_end|>",)},
    "llama3": {"user": ["<|start_header_id|>user<|end_header_id|>\n\n{{content}}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"], "system": ["<|start_header_id|>system<|end_header_id|>\n\n{{content}}<|eot_id|>"], "observation": ["<|start_header_id|>tool<|end_header_id|>\n\n{{content}}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n"], "prefix": [_BOS], "stop_words": ("<|eot_id|>",), "replace_eos": True},
    "mistral": _INST,
    "mixtral": _INST,
    "magistral": {"user": ["[INST]{{content}}[/INST]"], "assistant": ["{{content}}", _EOS], "system": ["[SYSTEM_PROMPT]{{content}}[/SYSTEM_PROMPT]"], "prefix": [_BOS], "kind": "reasoning"},
    "gemma": {"user": ["<start_of_turn>user\n{{content}}<end_of_turn>\n<start_of_turn>model\n"], "observation": ["<start_of_turn>tool\n{{content}}<end_of_turn>\n<start_of_turn>model\n"], "separator": ["<end_of_turn>\n"], "prefix": [_BOS], "efficient_eos": True},
    "llama2": {"user": [_BOS, "[INST] {{content}} [/INST]"], "system": ["<<SYS>>\n{{content}}\n<</SYS>>\n\n"], "kind": "folded"},
    "alpaca": {"user": ["### Instruction:\n{{content}}\n\n### Response:\n"], "separator": ["\n\n"], "default_system": "Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n"},
    "deepseek2": _COLON,
    "deepseek2-lite": _COLON,
    "minicpm3": _COLON,
    "baichuan2": {"user": ["<reserved_106>{{content}}<reserved_107>"], "efficient_eos": True},
    "deepseek3": {"user": ["<｜User｜>{{content}}<｜Assistant｜>"], "prefix": [_BOS]},
    "intern2": {"user": [_IM_USER], "assistant": [_IM_ANSWER], "system": [_IM_SYSTEM], "prefix": [_BOS], "stop_words": ("<|im_end|>",)},
    "hunyuan": {"user": ["{{content}}"], "assistant": ["{{content}}"], "default_system": "You are a helpful assistant."},
    "qwen3": {"user": [_IM_USER], "assistant": [_IM_ANSWER], "system": [_IM_SYSTEM], "function": [_IM_ANSWER], "observation": [_IM_RESULT], "stop_words": ("<|im_end|>",), "tool_style": "tagged", "replace_eos": True, "kind": "reasoning"},
    "bailing_mini": {"user": ["<role>HUMAN</role>{{content}}<|role_end|><role>ASSISTANT</role>"], "assistant": ["{{content}}<|role_end|>"], "system": ["<role>SYSTEM</role>{{content}}<|role_end|>"], "observation": ["<role>OBSERVATION</role>\n<tool_response>\n{{content}}\n</tool_response><|role_end|><role>ASSISTANT</role>"], "function": ["{{content}}<|role_end|>"], "stop_words": ("<|endoftext|>",), "tool_style": "tagged_plain", "efficient_eos": True},
    "plm": {"user": [_IM_USER], "assistant": [_IM_ANSWER], "system": [_IM_SYSTEM], "default_system": "You are a helpful assistant.", "stop_words": ("<|endoftext|>",), "replace_eos": True},
    "gpt_oss": {"user": ["<|start|>user<|message|>{{content}}<|end|><|start|>assistant"], "assistant": ["{{content}}<|end|>"], "system": ["<|start|>system<|message|>{{content}}<|end|>"], "thought": ("<|channel|>analysis<|message|>", "<|end|><|start|>assistant<|channel|>final<|message|>"), "default_system": "You are ChatGPT, a large language model trained by OpenAI.", "efficient_eos": True, "kind": "reasoning"},
}
